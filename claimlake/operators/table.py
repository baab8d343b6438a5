"""Tables of immutable Parquet files under numbered manifests.

A table is a folder with ``data`` (a folder for each commit, never changed) and ``log`` (a manifest for each
version). A manifest names the folders that make up its version, for a keyed table one for each bucket of the
key's hash, with their rows; the number of buckets stands in it, so no caller can get it wrong, and grows when
buckets do. A version exists from the moment its manifest does: that is put in place by one create-if-absent,
which one of several racing writers wins. The loser takes its files along if the winner changed other
buckets, else it works anew from the winner's version. A crash before that moment leaves files that no manifest
names, which :meth:`VersionedTable.vacuum` removes; nothing is ever half there.

``tag`` (a name and a number, as of a stream's batch) makes a commit happen once: a manifest keeps the
highest number of each name, and a commit that isn't above it does nothing.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .merge import upsert

BUCKET = "_bucket"
#: Rows of a bucket, about, above which the next commit doubles the number of buckets.
ROWS_PER_BUCKET = 2_000_000
RETRIES = 20


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so that joins with it fall away."""
    return spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).where(F.lit(False))


class Conflict(RuntimeError):
    """Another writer committed first, and what was to be written depends on the version before."""


@dataclass(frozen=True)
class Snapshot:
    """One version: ``parts`` has, by bucket or commit, the folder under the table and its rows."""

    version: int = -1
    keys: tuple[str, ...] = ()
    buckets: int = 0
    schema: str | None = None
    form: str = "parquet"
    parts: dict[str, tuple[str, int]] = field(default_factory=dict)
    tags: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.parts.values())

    def dump(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def load(text: str) -> Snapshot:
        raw = json.loads(text)
        return Snapshot(**raw | {"keys": tuple(raw["keys"]), "parts": {k: tuple(v) for k, v in raw["parts"].items()}})


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- files

    def _path(self, where: str):
        return self._jvm.org.apache.hadoop.fs.Path(where)

    def _write_text(self, where: str, text: str) -> None:
        out = self._fs.create(self._path(where), True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read_text(self, where: str) -> str:
        stream = self._fs.open(self._path(where))
        text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text

    def _put_if_absent(self, where: str, text: str) -> bool:
        """One atomic step. Renames don't replace a file on HDFS; on a local file system they do, but links don't."""
        draft = f"{self.path}/log/.{uuid.uuid4().hex}"
        self._write_text(draft, text)
        if self._fs.getUri().getScheme() != "file":
            done = bool(self._fs.rename(self._path(draft), self._path(where)))
        else:
            local = lambda p: self._path(p).toUri().getPath()
            try:
                os.link(local(draft), local(where))
                done = True
            except FileExistsError:
                done = False
        if self._fs.exists(self._path(draft)):
            self._fs.delete(self._path(draft), False)
        return done

    def versions(self) -> list[int]:
        log = self._path(f"{self.path}/log")
        if not self._fs.exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _manifest(self, version: int) -> str:
        return f"{self.path}/log/{version:020d}.json"

    # ---- reading

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The given or the latest version; an empty one (-1) before the first commit."""
        if version is None:
            there = self.versions()
            if not there:
                return Snapshot()
            version = there[-1]
        return Snapshot.load(self._read_text(self._manifest(version)))

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The rows of a version; with ``only``, of some buckets."""
        return self._rows(self.snapshot(version), only)

    def _rows(self, at: Snapshot, only: list[int] | None = None) -> DataFrame:
        if at.schema is None:
            raise FileNotFoundError(f"no version of {self.path}")
        schema = StructType.fromJson(json.loads(at.schema))
        folders = [f"{self.path}/{f}" for k, (f, n) in at.parts.items() if n and (only is None or int(k) in only)]
        if not folders:
            return no_rows(self.spark, schema)
        # From the common base on, the names of folders are columns, of which those of the table stay.
        return self.spark.read.schema(schema).format(at.form).option("basePath", f"{self.path}/data").load(folders).select([F.col(f"`{c}`") for c in schema.names])

    def read_of(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows whose bucket has one of ``keys``: all rows of these keys, and others. Only such buckets are read."""
        at = self.snapshot(version)
        return self._rows(at, self._touched(keys, at))

    def _number(self, at: Snapshot) -> Column:
        return F.pmod(F.xxhash64(*at.keys), F.lit(at.buckets)).cast("int")

    def _touched(self, keys: DataFrame, at: Snapshot) -> list[int]:
        return sorted(r[0] for r in keys.select(self._number(at).alias("b")).distinct().collect())  # as many as buckets

    # ---- writing

    def upsert(self, changes: DataFrame, keys: list[str], gone: DataFrame | None = None, tag: tuple[str, int] | None = None, buckets: int = 16, expected: int | None = None, within: list[str] | None = None) -> Snapshot:
        """``changes`` in place of the rows of their keys; those of ``gone`` (keys) go anyway. Returns the version.

        With ``within``, rows of a key are told apart by these columns too, in ``changes`` and ``gone``. Only buckets with such keys are written. ``buckets`` counts for a new table only. If ``changes`` derive from
        a version of this table, say so by ``expected``; then another writer's commit in between is a Conflict.
        """

        own = [*keys, *(within or [])]

        def rows(base: Snapshot) -> tuple[Snapshot, DataFrame, list[int] | None]:
            if base.version < 0:
                return replace(base, keys=tuple(keys), buckets=buckets), changes, None
            if base.keys != tuple(keys):
                raise ValueError(f"{self.path} has the keys {base.keys}")
            if base.rows > base.buckets * ROWS_PER_BUCKET:
                more = replace(base, buckets=base.buckets << max(1, (base.rows // (base.buckets * ROWS_PER_BUCKET)).bit_length()), parts={})
                return more, _merged(self._rows(base), changes, own, gone), None
            ids = changes.select(keys) if gone is None else changes.select(keys).unionByName(gone.select(keys))
            touched = self._touched(ids, base)
            return base, _merged(self._rows(base, touched), changes, own, gone), touched

        def write(base: Snapshot, folder: str) -> tuple[Snapshot, set[str]]:
            plan, df, touched = rows(base)
            if touched == []:
                return replace(plan), set()
            # A bucket of many rows is written by several tasks, as adaptive execution splits what one of them would get.
            df.withColumn(BUCKET, self._number(plan)).hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
            seen = self._counts(folder, df.schema, "parquet", BUCKET)
            parts = {k: v for k, v in plan.parts.items() if touched is not None and int(k) not in touched}
            parts |= {b: (f"{folder}/{BUCKET}={b}", n) for b, n in seen.items()}
            return replace(plan, parts=parts, schema=df.schema.json()), {str(b) for b in touched} if touched is not None else {"*"}

        return self._commit(write, tag, expected)

    def append(self, df: DataFrame, partition_by: str | None = None, tag: tuple[str, int] | None = None, form: str = "parquet") -> Snapshot:
        """Rows beside those that are there, in folders by a column if one is given."""

        def write(base: Snapshot, folder: str) -> tuple[Snapshot, set[str]]:
            out = df.write.format(form)
            (out.partitionBy(partition_by) if partition_by else out).save(f"{self.path}/{folder}")
            n = sum(self._counts(folder, df.schema, form, None).values())
            return replace(base, parts=base.parts | {folder: (folder, n)}, schema=df.schema.json(), form=form), set()

        return self._commit(write, tag, None)

    def _counts(self, folder: str, schema: StructType, form: str, by: str | None) -> dict[str, int]:
        rows = self.spark.read.format(form).schema(StructType([*schema.fields, StructField(by, IntegerType())]) if by else schema).load(f"{self.path}/{folder}")
        return {str(r[0]): r[1] for r in rows.groupBy(F.col(by) if by else F.lit("all")).agg(F.count(F.lit(1))).collect()}

    def _commit(self, write: Callable[[Snapshot, str], tuple[Snapshot, set[str]]], tag: tuple[str, int] | None, expected: int | None) -> Snapshot:
        """Write from the latest version, then put the next manifest; lost races are settled or tried again."""
        made: tuple[Snapshot, set[str], Snapshot, str] | None = None  # what was written, buckets, from which version, where
        for _ in range(RETRIES):
            base = self.snapshot()
            if tag is not None and base.tags.get(tag[0], -1) >= tag[1]:
                return base
            if expected is not None and base.version != expected:
                raise Conflict(f"{self.path}: version {base.version} came after {expected}")
            if made is not None:
                made = self._carried(made, base)
            if made is None:
                folder = f"data/_commit={uuid.uuid4().hex}"
                new, touched = write(base, folder)
                made = (new, touched, base, folder)
            new = replace(made[0], version=base.version + 1, tags=base.tags | ({tag[0]: tag[1]} if tag else {}))
            if self._put_if_absent(self._manifest(new.version), new.dump()):
                return new
        raise Conflict(f"{self.path}: no commit in {RETRIES} tries")

    def _carried(self, made: tuple[Snapshot, set[str], Snapshot, str], base: Snapshot) -> tuple[Snapshot, set[str], Snapshot, str] | None:
        """What was written from an older version, on top of ``base``, if no bucket of it has changed; else it goes."""
        new, touched, before, folder = made
        changed = {k for k in base.parts.keys() | before.parts.keys() if base.parts.get(k) != before.parts.get(k)}
        same = (base.keys, base.buckets, base.schema) == (before.keys, before.buckets, before.schema) == (new.keys, new.buckets, new.schema)
        if same and "*" not in touched and not touched & changed:
            own = {k: v for k, v in new.parts.items() if v[0].startswith(f"{folder}/") or v[0] == folder}
            kept = {k: v for k, v in base.parts.items() if k not in touched}
            return replace(new, parts=kept | own), touched, base, folder
        self._fs.delete(self._path(f"{self.path}/{folder}"), True)
        return None

    # ---- upkeep

    def expire(self, keep: int = 10) -> list[int]:
        """Drop all versions but the last ``keep``, and the folders that only they name. Returns what went."""
        gone = self.versions()[: -max(1, keep)]
        old = [self.snapshot(v) for v in gone]
        for v in gone:  # first the manifests, so that none ever names a folder that isn't there
            self._fs.delete(self._path(self._manifest(v)), False)
        named = self._named()
        for folder in {f for s in old for f, _ in s.parts.values()} - named:
            self._fs.delete(self._path(f"{self.path}/{folder}"), True)
        return gone

    def _named(self) -> set[str]:
        return {f for v in self.versions() for f, _ in self.snapshot(v).parts.values()}

    def vacuum(self, older_than: float = 24 * 3600) -> int:
        """Remove commits that no manifest names and drafts, if older than so many seconds: of writers that died."""
        named = {f.split("/")[1] for f in self._named()}
        removed = 0
        for where, keep in ((f"{self.path}/data", lambda n: n in named), (f"{self.path}/log", lambda n: n.endswith(".json") and n[0].isdigit())):
            if not self._fs.exists(self._path(where)):
                continue
            for s in self._fs.listStatus(self._path(where)):
                if not keep(s.getPath().getName()) and time.time() - s.getModificationTime() / 1000 >= older_than:
                    self._fs.delete(s.getPath(), True)
                    removed += 1
        return removed


def _merged(old: DataFrame | None, changes: DataFrame, keys: list[str], gone: DataFrame | None) -> DataFrame:
    return upsert(old if gone is None else old.join(gone.select(keys).distinct(), keys, "left_anti"), changes, keys)
