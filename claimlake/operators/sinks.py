"""Writers of bronze, silver and gold tables."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import freed
from .table import Snapshot, VersionedTable


def append_bronze(df: DataFrame, path: str) -> None:
    """K1: append, partitioned by the day of the change."""
    df.withColumn("cdc_date", F.to_date("_cdc_timestamp")).write.mode("append").partitionBy("cdc_date").parquet(path)


def append_bronze_once(spark: SparkSession, df: DataFrame, path: str, tag: tuple[str, int]) -> Snapshot:
    """ST1: :func:`append_bronze` to a versioned table; a batch (``tag``: stream and number) that comes again changes nothing."""
    return VersionedTable(spark, path).append(df.withColumn("cdc_date", F.to_date("_cdc_timestamp")), "cdc_date", tag)


def as_payload(df: DataFrame, source_table: str, operation: str = "I", at: Column | None = None) -> DataFrame:
    """K1: change events with the row as JSON."""
    return df.select(F.lit(operation).alias("_cdc_operation"), (at if at is not None else F.current_timestamp()).alias("_cdc_timestamp"), F.lit(source_table).alias("_source_table"), F.to_json(F.struct(*df.columns)).alias("payload"))


def overwrite(df: DataFrame, path: str) -> None:
    """K3, K5."""
    df.write.mode("overwrite").parquet(path)


def write_gold(df: DataFrame, path: str, at: Column | None = None) -> dict:
    """K4, K7: overwrite with ``_gold_ts``; returns the row count, observed while writing."""
    seen = Observation()
    df.withColumn("_gold_ts", at if at is not None else F.current_timestamp()).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get


def write_topics(events: DataFrame, path: str) -> None:
    """Events as JSON, a folder a topic."""
    events.write.mode("append").partitionBy("topic").json(path)


def write_topics_once(spark: SparkSession, events: DataFrame, path: str, tag: tuple[str, int]) -> Snapshot:
    """ST6: :func:`write_topics` to a versioned table; a batch that comes again changes nothing."""
    return VersionedTable(spark, path).append(events, "topic", tag, form="json")


def text_files(rows: DataFrame, path: str, order: list[str], join: str = "", head: str = "", tail: str = "", text: Column | str = "text", packed: bool = False) -> int:
    """Rows (folder, file_no, text) as a file for each file_no, its texts by ``order``; returns how many files there are.

    ``text`` may be made of other columns of the rows, which are then shuffled in its place. With ``packed`` the files
    are gzip ones, which Spark reads like plain ones, but not in splits.

    A file is written row by row, so it may be larger than a task's memory; a null text adds nothing. Files are made
    through pyarrow, as Hadoop's local file system starts two processes for each. They get their names when they are
    whole, so a task that is run again leaves the same ones. What the job shuffled is freed when it ends.
    """
    spark = rows.sparkSession
    ending = ".txt.gz" if packed else ".txt"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    uri = f"file://{where.toUri().getPath()}" if fs.getUri().getScheme() == "file" else path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(uri)
        now, stream, out, draft, first, n, made = None, None, None, "", True, 0, set()

        def close() -> None:
            nonlocal n
            if out is not None:
                out.write(f"{tail}\n".encode())
                out.close()
                if packed:
                    stream.close()
                fs.move(draft, f"{base}/folder={now[0]}/{now[1]}{ending}")
                n += 1

        for batch in batches:
            folders, numbers = batch.column("folder"), batch.column("file_no")
            numbers = numbers.to_pylist()
            starts = [i for i in range(len(numbers)) if not i or numbers[i] != numbers[i - 1]]
            for i, j in zip(starts, [*starts[1:], len(batch)], strict=True):
                at = folders[i].as_py(), numbers[i]
                if at != now:
                    close()
                    now, first = at, True
                    if at[0] not in made:
                        fs.create_dir(f"{base}/folder={at[0]}", recursive=True)
                        made.add(at[0])
                    draft = f"{base}/folder={at[0]}/.{at[1]}-{uuid.uuid4().hex}"
                    stream = fs.open_output_stream(draft)
                    out = gzip.GzipFile("", "wb", 1, stream, 0) if packed else stream
                    out.write(head.encode())
                texts = pc.drop_null(batch.column("text")[i:j]).to_pylist()
                if texts:
                    out.write(((join if not first else "") + join.join(texts)).encode())
                    first = False
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    made_of = F.col(text) if isinstance(text, str) else text
    placed = rows.repartition("folder").sortWithinPartitions("folder", "file_no", *order).select("folder", "file_no", made_of.alias("text"))
    with freed(spark):
        return placed.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
