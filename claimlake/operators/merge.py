"""Change capture, keyed merges and slowly changing dimensions as joins."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CDC_COLUMNS, OPEN_END


def _same(keys: list[str], a: str = "o", b: str = "n") -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def row_hash(columns: list[str]) -> Column:
    """Digest of a row's canonical JSON with its columns in order of name; nulls are written out."""
    return F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def snapshot_diff(table: DataFrame, keys: list[str], state: DataFrame | None, source_table: str, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, new state) of a snapshot against the stored hash of each row.

    New keys are ``I``, changed rows ``U`` and vanished keys ``D`` (payload: the key alone).
    """
    at = at if at is not None else F.current_timestamp()
    now = table.select(F.to_json(F.struct(*keys)).alias("row_pk"), row_hash(table.columns).alias("row_hash"), F.to_json(F.struct(*table.columns)).alias("payload"))
    old = (state if state is not None else now.select("row_pk", "row_hash").limit(0)).select("row_pk", F.col("row_hash").alias("old_hash"))
    both = now.join(old, "row_pk", "full_outer")
    op = F.when(F.col("old_hash").isNull(), "I").when(F.col("row_hash").isNull(), "D").when(F.col("row_hash") != F.col("old_hash"), "U")
    events = both.withColumn("_cdc_operation", op).where("_cdc_operation is not null").select(
        "_cdc_operation", at.alias("_cdc_timestamp"), F.lit(source_table).alias("_source_table"), "row_pk", F.coalesce("payload", "row_pk").alias("payload")
    )
    return events, now.select("row_pk", "row_hash")


def watermark_changes(table: DataFrame, column: str, last: object | None) -> tuple[DataFrame, DataFrame]:
    """Rows after the watermark, all as ``I``, and the next watermark (that of before, if there are none)."""
    rows = table if last is None else table.where(F.col(column) > F.lit(last))
    return rows.withColumn("_cdc_operation", F.lit("I")), rows.agg(F.coalesce(F.max(column), F.lit(last).cast(dict(table.dtypes)[column])).alias("watermark"))


def sync_state(events: DataFrame, state: DataFrame | None, at: Column | None = None) -> DataFrame:
    """For each source table the last sync, its rows, and counts of operations over all syncs."""
    at = at if at is not None else F.current_timestamp()
    count = lambda op: F.count_if(F.col("_cdc_operation") == op)
    now = events.groupBy("_source_table").agg(F.count("*").alias("rows"), count("I").alias("i"), count("U").alias("u"), count("D").alias("d"))
    if state is None:
        old = now.select("_source_table", *[F.lit(None).cast("long").alias(c) for c in ("inserts", "updates", "deletes")], F.lit(None).cast("timestamp").alias("was")).limit(0)
    else:
        old = state.select("_source_table", "inserts", "updates", "deletes", F.col("last_sync").alias("was"))
    zero = F.lit(0)
    add = lambda a, b: F.coalesce(a, zero) + F.coalesce(b, zero)
    return now.join(old, "_source_table", "full_outer").select(
        "_source_table", F.when(F.col("rows").isNotNull(), at).otherwise(F.col("was")).alias("last_sync"), F.coalesce("rows", zero).alias("rows_last_sync"), add("inserts", "i").alias("inserts"), add("updates", "u").alias("updates"), add("deletes", "d").alias("deletes")
    ).orderBy("_source_table")


def op_rank(op: str = "_cdc_operation") -> Column:
    """Of events at one moment a delete counts last, an insert first."""
    return F.when(F.col(op) == "D", 2).when(F.col(op) == "U", 1).otherwise(0)


def resolve_cdc(events: DataFrame, keys: list[str], keep_deleted: bool = False) -> DataFrame:
    """C4: the current row of each key. The last event counts (time, then sequence, then kind); deleted keys go.

    A maximum over structs combines in the tasks before the shuffle, so a key with many events is no hot spot.
    """
    seq = F.col("_cdc_seq") if "_cdc_seq" in events.columns else F.lit(0)
    rest = [c for c in events.columns if c not in keys]
    order = F.struct(F.col("_cdc_timestamp"), seq, op_rank())
    last = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")
    out = last if keep_deleted else last.where("_cdc_operation <> 'D'")
    return out.drop(*([c for c in CDC_COLUMNS if not keep_deleted]))


def enrich_bronze(df: DataFrame, source_table: str, at: Column | None = None, source_file: Column | None = None) -> DataFrame:
    """Default operation, time and lineage columns, where they are missing."""
    at = at if at is not None else F.current_timestamp()
    default = {"_cdc_operation": F.lit("I"), "_cdc_timestamp": at, "_source_table": F.lit(source_table), "_bronze_loaded_ts": at, "_source_file": source_file if source_file is not None else F.lit(None).cast("string")}
    return df.withColumns({c: v for c, v in default.items() if c not in df.columns})


def upsert(existing: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """K2, M1: ``existing`` with the rows of ``changes`` in place of those of the same key, new ones added."""
    kept = existing.alias("o").join(changes.select(keys).distinct().alias("n"), _same(keys), "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def scd1_merge(existing: DataFrame, staged: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """M1: upsert with the action of each row: inserted, updated, or unchanged."""
    o, n = existing.alias("o"), staged.alias("n")
    differs = reduce(lambda x, y: x | y, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in tracked])
    here, there = F.col("o._here").isNotNull(), F.col("n._there").isNotNull()
    both = o.withColumn("_here", F.lit(1)).alias("o").join(n.withColumn("_there", F.lit(1)).alias("n"), _same(keys), "full_outer")
    action = F.when(~here, "inserted").when(there & differs, "updated").otherwise("unchanged")
    pick = [F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in existing.columns]
    return both.select(*pick, action.alias("merge_action"))


def scd2_merge(history: DataFrame, staged: DataFrame, keys: list[str], tracked: list[str], effective: str = "effective_date") -> DataFrame:
    """M2, M3: all versions after ``staged`` came in, with the action of each row.

    The staged rows of a key are folded in order of effective date (of several of one date the last by its
    values counts). Each whose tracked values differ from those before it closes that version the day before
    it takes effect and becomes the new current one; null equals null. A version whose ``is_current`` is null
    is a current one. ``history`` has valid_from, valid_to and is_current beside keys and tracked columns;
    other columns of it are kept and null in new versions unless ``staged`` has them.
    """
    open_ = F.coalesce(F.col("is_current"), F.lit(1)) != 0
    past = history.where(~open_).withColumn("merge_action", F.lit("history"))
    kinds = dict(history.dtypes)
    rest = [c for c in staged.columns if c not in keys and c != effective]
    once = staged.groupBy(*keys, effective).agg(F.max(F.struct(*tracked, *[c for c in rest if c not in tracked])).alias("_r")).select(*keys, effective, "_r.*")
    made = {"valid_from": F.col(effective), "valid_to": F.lit(OPEN_END).cast("date"), "is_current": F.lit(1)}
    new = once.select([(made[c] if c in made else F.col(c) if c in once.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in history.columns]).withColumn("_new", F.lit(1))
    rows = history.where(open_).withColumn("_new", F.lit(0)).unionByName(new)
    order = Window.partitionBy(*keys).orderBy("_new", "valid_from", *tracked)
    values = F.struct(*[F.col(c) for c in tracked])
    changed = (F.col("_new") == 0) | F.lag(F.lit(1)).over(order).isNull() | ~values.eqNullSafe(F.lag(values).over(order))
    kept = rows.withColumn("_changed", changed).where("_changed").withColumn("_next", F.lead("valid_from").over(order))
    last = F.col("_next").isNull()
    return (
        kept.withColumns(
            {
                "valid_to": F.when(last, F.col("valid_to")).otherwise(F.date_sub("_next", 1)),
                "is_current": F.when(last, 1).otherwise(0).cast(kinds["is_current"]),
                "merge_action": F.when(F.col("_new") == 1, "inserted").when(last, "unchanged").otherwise("closed"),
            }
        )
        .drop("_new", "_changed", "_next")
        .unionByName(past)
    )


def merge_counts(merged: DataFrame) -> DataFrame:
    """M5."""
    return merged.groupBy("merge_action").agg(F.count("*").alias("n"))


#: Facts of one key above which they are cut by date into slices of about so many.
HOT_FACTS = 1_000_000
#: Hot keys up to which their slices are broadcast, and slices of a key.
BROADCAST_KEYS, MAX_SLICES = 10_000, 1_000


def _active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From versions (key, start, after, rank) by key and start: the highest rank that is active from each moment on.

    A rank of null says that none is. Of a key only the versions that overlap are held.
    """
    key, open_, now, out = None, [], None, []

    def until(moment: float) -> None:
        """Close versions that end up to ``moment``."""
        nonlocal now
        while open_ and open_[0][1] <= moment:
            ended = -open_[0][0]
            at = open_[0][1]
            heapq.heappop(open_)
            while open_ and open_[0][1] <= at:  # ended before it, under it
                heapq.heappop(open_)
            if ended == now:
                now = -open_[0][0] if open_ else None
                out.append((key, at, now))

    def rows() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64())], ["key", "start", "rank"])
        out.clear()
        return made

    for batch in batches:
        for k, start, after, rank in zip(*[batch.column(c).to_pylist() for c in ("key", "start", "after", "rank")], strict=True):
            if k != key:
                until(math.inf)
                key, now = k, None
                open_.clear()
            until(start)
            heapq.heappush(open_, (-rank, after))
            if now is None or rank > now:
                now = rank
                out.append((key, start, now))
        yield rows()
    until(math.inf)
    yield rows()


def _moment(c: Column, kind: str) -> Column:
    """A date or time as a whole number, of which the next one is a day or a microsecond later."""
    return (F.unix_date(c) if kind == "date" else F.unix_micros(c.cast("timestamp"))).cast("long")


def as_of_lookup(facts: DataFrame, history: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """M4: ``facts`` with the value of the version valid on ``at`` (both ends count); null without one.

    Where versions overlap, the current one counts, then the latest start, then the highest value. The versions of
    a key are first turned into stretches that don't overlap, in one sweep that holds the active ones. Facts
    and the starts of stretches are then one sorted sequence a key, in which each fact takes the last start before
    it: as many rows as facts and stretches, however many versions a key has. Facts of a key with over
    HOT_FACTS are cut into slices by date, each with the stretch that it begins in.
    """
    kind = dict(history.dtypes)["valid_from"]
    kinds = dict(history.dtypes)
    key = lambda: F.to_json(F.struct(*[F.col(k).cast(kinds[k]).alias(k) for k in keys]))
    some = history.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys]) & (F.col("valid_from") <= F.col("valid_to")))
    order = Window.partitionBy("key").orderBy("is_current", "valid_from", value)
    versions = some.select(key().alias("key"), "is_current", "valid_from", F.col(value), _moment(F.col("valid_from"), kind).alias("start"), (_moment(F.col("valid_to"), kind) + 1).alias("after")).withColumn("rank", F.row_number().over(order).cast("long"))
    sweep = versions.select("key", "start", "after", "rank").repartition("key").sortWithinPartitions("key", "start", "rank").mapInArrow(_active, "key string, start long, rank long")
    last = sweep.groupBy("key", "start").agg(F.max(F.coalesce("rank", F.lit(-1))).alias("rank"))  # what a moment ends with
    stretches = last.join(versions.select("key", "rank", F.struct(F.col(value).alias("v")).alias("found")), ["key", "rank"], "left").select("key", "start", F.coalesce("found", F.struct(F.lit(None).cast(kinds[value]).alias("v"))).alias("found"))
    rows = facts.select(key().alias("key"), _moment(F.col(at), kind).alias("at"), F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("row"))
    counted = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_FACTS)
    n_hot, most = counted.agg(F.count("*"), F.max("n")).first()
    if n_hot:
        shares = [i / n for n in [min(MAX_SLICES, -(-most // HOT_FACTS))] for i in range(1, n)]
        hot = rows.select("key", "at").join(counted.select("key"), "key", "left_semi").groupBy("key").agg(F.array_distinct(F.percentile_approx("at", shares, 10 * MAX_SLICES)).alias("cuts"))
        hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
        number = lambda c: F.coalesce(F.size(F.filter("cuts", lambda x: x <= F.col(c))), F.lit(0))
        rows = rows.join(hot, "key", "left").withColumn("slice", number("at")).drop("cuts")
        after = F.coalesce(F.lead("start").over(Window.partitionBy("key").orderBy("start")), F.lit(2**62))
        reach = stretches.withColumn("end", after - 1).join(hot, "key", "left").withColumn("first", number("start"))
        stretches = reach.withColumn("slice", F.explode(F.sequence("first", number("end")))).select("key", "slice", F.when(F.col("slice") == F.col("first"), F.col("start")).otherwise(F.get("cuts", F.col("slice") - 1)).alias("start"), "found")
    else:
        rows, stretches = rows.withColumn("slice", F.lit(0)), stretches.withColumn("slice", F.lit(0))
    both = rows.select("key", "slice", "at", F.lit(1).alias("is_fact"), "row", F.lit(None).cast(stretches.schema["found"].dataType).alias("found")).unionByName(stretches.select("key", "slice", F.col("start").alias("at"), F.lit(0).alias("is_fact"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"), "found"))
    line = Window.partitionBy("key", "slice").orderBy("at", "is_fact").rowsBetween(Window.unboundedPreceding, 0)
    found = F.when(F.col("at").isNotNull(), F.last("found", ignorenulls=True).over(line)["v"])
    return both.withColumn("value", found).where("is_fact = 1").select("row.*", F.col("value").alias(value))


def yearly_history(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Closed intervals out of versions with a start: each ends the day before the next one of its key."""
    after = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    return versions.withColumn("valid_to", F.coalesce(F.date_sub(after, 1), F.lit(OPEN_END).cast("date"))).withColumn("is_current", F.when(after.isNull(), 1).otherwise(0))
