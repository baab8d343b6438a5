"""Structured Streaming jobs: incremental bronze, idempotent ingest, windows, stream joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ingest, merge, sinks
from ..operators.table import VersionedTable
from ..plans.incremental import GoldViews


def source(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Files as they arrive; each is read once, as the checkpoint remembers it."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", 1000).load(path)


def _tag(batch: DataFrame, number: int) -> tuple[str, int]:
    """What a table remembers of a batch: the query, which its checkpoint keeps over restarts, and the batch's number."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream", number


def bronze(spark: SparkSession, path: str, schema, source_table: str, out: str, checkpoint: str) -> StreamingQuery:
    """ST1: new files to bronze (a versioned table), then stop; run again for later files.

    A batch that is run again, as after a crash between its write and its entry in the checkpoint, adds nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        sinks.append_bronze_once(batch.sparkSession, merge.enrich_bronze(batch, source_table), out, _tag(batch, number))

    return source(spark, path, schema).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_claims(stream: DataFrame, claims_path: str, lines_path: str, checkpoint: str) -> StreamingQuery:
    """ST2: insert, replace, void or skip claims of each batch against the stored ones, in versioned tables by claim_id.

    All lines of a replaced claim go. A batch reads and writes only buckets with its claims. Lines are committed
    first and claims, from which the actions derive, last, each once a batch: a run that stops in between
    finds the claims as they were, and takes the same actions again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, tag = batch.sparkSession, _tag(batch, number)
        stored_claims, stored_lines = VersionedTable(spark, claims_path), VersionedTable(spark, lines_path)
        claims, lines = stored_claims.read_of(batch), stored_lines.read_of(batch)
        acted = ingest.claim_actions(batch, claims).persist()  # both tables take it several times
        try:
            new_claims, new_lines = ingest.apply_claim_actions(claims, lines, acted)
            ids = acted.where("action <> 'skip'").select("claim_id").distinct()
            stored_lines.upsert(new_lines.join(ids, "claim_id", "left_semi"), ["claim_id"], gone=ids, tag=tag)
            stored_claims.upsert(new_claims.join(ids, "claim_id", "left_semi"), ["claim_id"], tag=tag)
        finally:
            acted.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: list[str], time: str, horizon: str = "1 hour") -> DataFrame:
    """ST3: the first event of each key within the horizon; state older than it is dropped."""
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark(keys)


def rolling_counts(stream: DataFrame, time: str, kind: str, width: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """ST4: events by window and kind; later than ``late`` is dropped."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    out = stream.withWatermark(time, late).groupBy(window.alias("w"), F.col(kind)).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), kind, "n")


def rolling_shares(stream: DataFrame, time: str, hit: Column, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """ST4: events, those that ``hit`` (errors by the hour, unmatched references by the day) and their share by window."""
    hits = F.count_if(F.coalesce(hit, F.lit(False)))
    out = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w")).agg(F.count("*").alias("n"), hits.alias("hits"), F.round(hits * 100.0 / F.count("*"), 2).alias("share_pct"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "hits", "share_pct")


def claims_with_remittances(claims: DataFrame, remits: DataFrame, days: int = 45) -> DataFrame:
    """ST5: each claim with the remittances that follow within ``days``; without one, once they are over."""
    c = claims.withWatermark("filed_at", "1 day").alias("c")
    r = remits.select(F.col("claim_id").alias("r_claim"), "paid_at", "paid_amount").withWatermark("paid_at", "1 day").alias("r")
    on = F.expr(f"c.claim_id = r.r_claim and r.paid_at >= c.filed_at and r.paid_at <= c.filed_at + interval {days} days")
    return c.join(r, on, "left_outer")


def fan_out(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """ST6: events to a folder for each topic, in a versioned table that takes each batch once."""
    write = lambda b, n: sinks.write_topics_once(b.sparkSession, b, path, _tag(b, n)) and None
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refresh_gold(stream: DataFrame, views: GoldViews, checkpoint: str) -> StreamingQuery:
    """ST7: gold brought up to date by each batch of change events, by their differences alone."""
    return stream.writeStream.foreachBatch(lambda b, n: views.apply(b, _tag(b, n))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over all that is there and write its rows as Parquet."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start().awaitTermination()
