"""Intermediate tables in the folder that every executor shares."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that Arrow hands to Python at once; texts may be very long, so few of them.
BATCH_ROWS, BATCH_BYTES = 256, 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder where it is unset, on one machine only."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="claimlake-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


_made: list[str] = []


@atexit.register
def _remove_made() -> None:
    """What this driver wrote into the shared folder goes when it ends."""
    for path in _made:
        try:
            fs, where = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
            fs.delete_dir(where)
        except (OSError, ValueError):  # gone already, or out of pyarrow's reach
            pass


def materialise(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there.

    Unlike a cached or locally checkpointed frame it survives the loss of any executor.
    """
    spark = df.sparkSession
    path = path or new_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`materialise` that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.shared_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Run:
    """The tables of one run of an operator, in a folder of its own, of which only the result stays."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.path = new_path(spark, tag)
        self.tables: list[DataFrame] = []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        out = materialise(df, name, f"{self.path}/{name}-{uuid.uuid4().hex[:8]}")
        self.tables.append(out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        for t in tables:
            discard(t)
            self.tables = [x for x in self.tables if x.shared_path != t.shared_path]

    def result(self, df: DataFrame) -> DataFrame:
        """Write the result; all other tables of the run go."""
        used, out = self.tables, self.table(df, "result")
        self.drop(*[t for t in used if t is not out])
        return out


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small enough for a Python worker, by rows and by bytes.

    These are settings of the session, and count when a plan runs; frames of this package rely on them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def packed(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """The ``wanted`` columns, and the whole row in a struct ``_row`` whose fields go by number.

    So no name of another column (with a dot, in other case, or one that an operator uses) can clash.
    """
    names = docs.columns
    safe = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return safe.select(*[F.col(f"c{names.index(w)}").alias(w) for w in wanted], F.struct(*safe.columns).alias("_row"))


def unpacked(rows: DataFrame, names: list[str], **new: Column) -> DataFrame:
    """The rows of :func:`packed` again, under their names; ``new`` columns take the place of their namesakes."""
    own = [(n, new[n] if n in new else F.col(f"_row.c{i}")) for i, n in enumerate(names)]
    own += [(n, c) for n, c in new.items() if n not in names]
    return rows.select([c.alias(f"c{i}") for i, (_, c) in enumerate(own)]).toDF(*[n for n, _ in own])


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def give_back() -> None:
    """Return freed memory of large temporary arrays to the system: Python workers outlive their tasks."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
