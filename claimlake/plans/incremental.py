"""Gold kept up to date by change events: sums and counts of groups are stored, and a batch adds its differences.

A batch of change events on claims and remittances names the claims that it touches. Their rows before and
after it come from the same plan as in a full build (:func:`silver.claim_remittance`); the rows before count
minus one and those after plus one, summed by group, and these differences are merged into the stored sums. So
a batch reads and writes only buckets with claims and groups that it touches; ratios are derived when the
tables are read. Amounts and shares of percent are decimals, so sums don't depend on the order of batches.

All four tables are versioned and take each batch once, the stored rows last: a batch that is run again
after a crash finds the differences that it hasn't added yet as they were. The changes of a batch are parsed
once, and are the rows that are merged into the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import mean, percent
from ..operators import merge
from ..operators.table import VersionedTable, no_rows
from . import silver
from .gold import BUCKETS
from .silver import as_date

CLAIM = "claim_id long, payer_id long, provider_npi long, date_of_service date, status string, total_billed decimal(18,2)"
REMITTANCE = "claim_id long, remit_id long, paid_amount decimal(18,2), allowed_amount decimal(18,2), denial_code string"
_SUMS = {
    "claims": "long",
    "billed": "decimal(38,2)",
    "paid": "decimal(38,2)",
    "underpaid": "decimal(38,2)",
    "denied": "long",
    "ratios": "decimal(38,10)",
    "ratio_count": "long",
}


def _typed(df: DataFrame, names: str) -> DataFrame:
    return df.select([F.col(c.split()[0]).cast(c.split()[1] if "decimal" not in c else c.split(None, 1)[1]) for c in names.split(", ")])


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(t).alias(c) for c, t in _SUMS.items()])


class GoldViews:
    """G1, G3 and G5 over claims and remittances as the events so far have left them."""

    def __init__(self, spark: SparkSession, path: str, payers: DataFrame, buckets: int = 16) -> None:
        self.spark, self.payers, self.buckets = spark, payers, buckets
        self.claims, self.remits, self.by_payer, self.by_day = (VersionedTable(spark, f"{path}/{name}") for name in ("claims", "remittances", "by_payer", "by_day"))

    # ---- batches

    def _stored(self, table: VersionedTable, ids: DataFrame, schema: str) -> DataFrame:
        if table.snapshot().version < 0:
            return no_rows(self.spark, StructType.fromDDL(schema))
        return table.read_of(ids).join(ids, "claim_id", "left_semi")

    def _changes(self, events: DataFrame, source: str, schema: str, keys: list[str]) -> DataFrame:
        """The last event of each row, with the row's columns."""
        own = events.where(F.col("_source_table") == source).withColumn("row", F.from_json("payload", schema))
        return merge.resolve_cdc(own.select("_cdc_operation", "_cdc_timestamp", "_cdc_seq", "row.*"), keys, keep_deleted=True)

    @staticmethod
    def _after(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
        new = changes.where("_cdc_operation <> 'D'").select(old.columns)
        return old.join(changes.select(keys), keys, "left_anti").unionByName(new)

    def apply(self, events: DataFrame, batch: tuple[str, int]) -> None:
        """Take in a batch of bronze events (payload: the row as JSON, of a delete its key), once."""
        made: list[DataFrame] = []

        def kept(df: DataFrame) -> DataFrame:
            made.append(df.persist())
            return df

        try:
            claims, remits = kept(self._changes(events, "claims", CLAIM, ["claim_id"])), kept(self._changes(events, "remittances", REMITTANCE, ["claim_id", "remit_id"]))
            ids = kept(claims.select("claim_id").unionByName(remits.select("claim_id")).distinct())
            old_claims, old_remits = self._stored(self.claims, ids, CLAIM), self._stored(self.remits, ids, REMITTANCE)
            new_claims, new_remits = self._after(old_claims, claims, ["claim_id"]), self._after(old_remits, remits, ["claim_id", "remit_id"])
            before, after = (silver.claim_remittance(c, r, self.payers) for c, r in ((old_claims, old_remits), (new_claims, new_remits)))
            rows = before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))
            ratio = F.when(F.col("total_billed") > 0, F.col("total_paid") * 100 / F.col("total_billed")).cast("decimal(28,10)")
            values = {"claims": F.lit(1), "billed": F.col("total_billed"), "paid": F.col("total_paid"), "underpaid": F.col("underpayment"), "denied": F.col("has_denial"), "ratios": F.coalesce(ratio, F.lit(0)), "ratio_count": ratio.isNotNull().cast("int")}
            signed = rows.select("payer_id", "date_of_service", *[(v.cast("decimal(28,10)" if k == "ratios" else "decimal(28,2)") * F.col("sign")).cast(_SUMS[k]).alias(k) for k, v in values.items()])
            cells = kept(_summed(signed, "payer_id", "date_of_service"))  # as many as payers times days, whatever the claims
            self._add(self.by_payer, cells.where("payer_id is not null"), "payer_id", batch)
            self._add(self.by_day, cells.where("date_of_service is not null"), "date_of_service", batch)
            live, gone = F.col("_cdc_operation") != "D", F.col("_cdc_operation") == "D"
            self.claims.upsert(_typed(claims.where(live), CLAIM), ["claim_id"], gone=claims.where(gone), tag=batch, buckets=self.buckets)
            self.remits.upsert(_typed(remits.where(live), REMITTANCE), ["claim_id"], gone=remits.where(gone), tag=batch, buckets=self.buckets, within=["remit_id"])
        finally:
            for df in made:
                df.unpersist()

    def _add(self, table: VersionedTable, signed: DataFrame, key: str, batch: tuple[str, int]) -> None:
        """Merge differences into the sums of their groups; a group without claims goes."""
        at = table.snapshot()
        if at.tags.get(batch[0], -1) >= batch[1]:
            return
        change = _summed(signed, key)
        groups = change.select(key)
        rows = change if at.version < 0 else change.unionByName(table.read_of(groups, at.version).join(groups, key, "left_semi"))
        sums = _summed(rows, key)
        table.upsert(sums.where("claims <> 0"), [key], gone=groups, tag=batch, buckets=self.buckets, expected=at.version)

    # ---- tables

    def recovery(self) -> DataFrame:
        """G1."""
        amount = lambda c: F.col(c).cast("double")
        return self.by_payer.read().join(self._names(), "payer_id", "left").select(
            "payer_id",
            "payer_name",
            F.col("claims").alias("total_claims"),
            amount("billed").alias("total_billed"),
            amount("paid").alias("total_paid"),
            amount("underpaid").alias("total_underpayment"),
            F.coalesce(F.round(amount("ratios") / F.nullif("ratio_count", F.lit(0)), 2), F.lit(0.0)).alias("avg_payment_pct"),
            F.col("denied").alias("denial_count"),
            percent(F.col("paid"), F.col("billed")).alias("recovery_rate_pct"),
            percent(F.col("denied"), F.col("claims")).alias("denial_rate_pct"),
        )

    def _names(self) -> DataFrame:
        return self.payers.select("payer_id", F.col("name").alias("payer_name"), F.col("type").alias("payer_type"))

    def scorecard(self) -> DataFrame:
        """G3."""
        paid, denied = percent(F.col("paid"), F.col("billed")), percent(F.col("denied"), F.col("claims"))
        tier = F.when((paid >= 80) & (denied <= 10), "low").when((paid >= 50) | (denied <= 30), "medium").otherwise("high")
        return self.by_payer.read().join(self._names(), "payer_id", "left").select(
            "payer_id", "payer_name", F.col("claims").alias("total_claims"), paid.alias("payment_rate_pct"), denied.alias("denial_rate_pct"), mean(F.col("underpaid"), F.col("claims")).alias("avg_underpayment"), F.col("underpaid").cast("double").alias("total_underpayment"), tier.alias("risk_tier"), "payer_type"
        )

    def aging(self, as_of: str | None = None) -> DataFrame:
        """Sums are kept by day, so any date can be asked for."""
        age: Column = F.datediff(as_date(as_of), F.col("date_of_service"))
        bucket = F.when(age <= 30, BUCKETS[0]).when(age <= 60, BUCKETS[1]).when(age <= 90, BUCKETS[2]).when(age <= 180, BUCKETS[3]).otherwise(BUCKETS[4])
        agg = self.by_day.read().groupBy(bucket.alias("aging_bucket")).agg(F.sum("claims").alias("claim_count"), F.sum("billed").cast("double").alias("total_billed"), F.sum("underpaid").cast("double").alias("total_unpaid"))
        return agg.withColumn("pct_of_total", F.round(F.col("claim_count") * 100.0 / F.sum("claim_count").over(Window.partitionBy()), 2))  # five rows
