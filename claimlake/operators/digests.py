"""Snapshot comparison by digests: only ranges of keys in which something changed are read and joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .merge import row_hash
from .table import VersionedTable

#: Leaves (buckets of keys by hash) under one node.
LEAVES = 16


class SnapshotState:
    """C1 against a stored state: the hash of each row in buckets by key, and a tree of digests over them.

    The digest of a leaf is its count and the sum of 128 bits of each row's key and hash, that of a node the sum of
    its leaves; sums don't depend on order, so one aggregation that combines in the tasks makes them. A
    comparison first looks at nodes, then at the leaves of those that differ, and then joins the rows of those
    leaves alone: of all others neither stored rows are read nor new ones shuffled.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256) -> None:
        self.spark, self.buckets = spark, buckets
        self.rows, self.leaves, self.nodes = (VersionedTable(spark, f"{path}/{name}") for name in ("rows", "leaves", "nodes"))

    @staticmethod
    def _part(digest: Column, first: int) -> Column:
        """64 bits of a digest in hexadecimal, as a whole number that isn't negative."""
        return F.conv(F.substring(digest, first, 16), 16, 10).cast("decimal(20,0)")

    def _digests(self, rows: DataFrame) -> DataFrame:
        both = F.md5(F.concat_ws("\u0001", "row_pk", "row_hash"))
        sums = [F.sum(self._part(both, i)).cast("decimal(38,0)").alias(n) for i, n in ((1, "high"), (17, "low"))]
        return rows.groupBy("leaf").agg(F.count("*").alias("n"), *sums).withColumn("node", (F.col("leaf") / LEAVES).cast("int"))

    def _differing(self, now: DataFrame, before: VersionedTable, key: str) -> list[int]:
        """Keys whose digests aren't the stored ones (of either side); as many as leaves or nodes at most."""
        cols = [key, "n", "high", "low"]
        old = before.read().select(cols)
        apart = now.select(cols).exceptAll(old).unionByName(old.exceptAll(now.select(cols)))
        return sorted(r[0] for r in apart.select(key).distinct().collect())

    def diff(self, table: DataFrame, keys: list[str], source_table: str, at: Column | None = None) -> DataFrame:
        """The events (as of :func:`merge.snapshot_diff`) of a snapshot against the state, which then is that snapshot.

        The events are stored with the commit of the state (``last_events``) and read from there.
        """
        at = at if at is not None else F.current_timestamp()
        now = table.select(F.to_json(F.struct(*keys)).alias("row_pk"), row_hash(table.columns).alias("row_hash"), F.to_json(F.struct(*table.columns)).alias("payload"))
        known = self.rows.snapshot()
        buckets = known.buckets or self.buckets
        now = now.withColumn("leaf", F.pmod(F.xxhash64("row_pk"), F.lit(buckets)).cast("int"))
        leaves = self._digests(now).persist()
        try:
            nodes = leaves.groupBy("node").agg(*[F.sum(c).cast("decimal(38,0)" if c != "n" else "long").alias(c) for c in ("n", "high", "low")])
            self.read_leaves = list(range(buckets))
            if known.version >= 0:
                far = self._differing(nodes, self.nodes, "node")
                mine = leaves.where(F.col("node").isin(far)) if far else leaves.limit(0)
                old = self.leaves.read().where(F.col("node").isin(far) if far else F.lit(False))
                cols = ["leaf", "n", "high", "low"]
                apart = mine.select(cols).exceptAll(old.select(cols)).unionByName(old.select(cols).exceptAll(mine.select(cols)))
                self.read_leaves = sorted(r[0] for r in apart.select("leaf").distinct().collect())
            empty = self.spark.createDataFrame([], "row_pk string, row_hash string")
            stored = self.rows.read(known.version, self.read_leaves) if known.version >= 0 else empty
            fresh = now.where(F.col("leaf").isin(self.read_leaves)) if len(self.read_leaves) < buckets else now
            both = fresh.drop("leaf").join(stored.select("row_pk", F.col("row_hash").alias("old_hash")), "row_pk", "full_outer")
            op = F.when(F.col("old_hash").isNull(), "I").when(F.col("row_hash").isNull(), "D").when(F.col("row_hash") != F.col("old_hash"), "U")
            events = both.withColumn("_cdc_operation", op).where("_cdc_operation is not null")
            events = events.select("_cdc_operation", at.alias("_cdc_timestamp"), F.lit(source_table).alias("_source_table"), "row_pk", F.coalesce("payload", "row_pk").alias("payload"), "row_hash").persist()
            try:
                out = VersionedTable(self.spark, f"{self.rows.path}.events")
                number = out.append(events.drop("row_hash"))
                kept = events.where("_cdc_operation <> 'D'").select("row_pk", "row_hash")
                self.rows.upsert(kept, ["row_pk"], gone=events.select("row_pk"), buckets=buckets, expected=known.version)
                self.leaves.upsert(leaves.select("leaf", "node", "n", "high", "low"), ["leaf"], gone=self._all(self.leaves, "leaf"), buckets=1)
                self.nodes.upsert(nodes, ["node"], gone=self._all(self.nodes, "node"), buckets=1)
                folder = next(f for k, (f, _) in number.parts.items() if k not in (out.snapshot(number.version - 1).parts if number.version else {}))
                return self.spark.read.schema(events.drop("row_hash").schema).parquet(f"{out.path}/{folder}")
            finally:
                events.unpersist()
        finally:
            leaves.unpersist()

    def _all(self, table: VersionedTable, key: str) -> DataFrame:
        return table.read().select(key) if table.snapshot().version >= 0 else self.spark.createDataFrame([], f"{key} int")
