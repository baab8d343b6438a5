"""Ordered and top-k reports over gold and operational tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gold import BUCKETS
from .silver import as_date


def by_underpayment(recovery: DataFrame) -> DataFrame:
    """R1."""
    return recovery.orderBy(F.desc("total_underpayment"), "payer_id")


def scorecards(scorecard: DataFrame) -> DataFrame:
    """R2, with a severity rank."""
    rank = F.when(F.col("risk_tier") == "high", 3).when(F.col("risk_tier") == "medium", 2).otherwise(1)
    return scorecard.withColumn("severity", rank).orderBy(F.desc("risk_tier"), F.desc("total_underpayment"), "payer_id")


def busiest_codes(cpt: DataFrame) -> DataFrame:
    """R3."""
    return cpt.orderBy(F.desc("claim_count"), "cpt_code")


def aging_in_order(aging: DataFrame) -> DataFrame:
    """R4."""
    place = reduce(lambda c, i: c.when(F.col("aging_bucket") == BUCKETS[i], i), range(1, len(BUCKETS)), F.when(F.col("aging_bucket") == BUCKETS[0], 0))
    return aging.withColumn("bucket_order", place).orderBy("bucket_order")


def pipeline_in_order(pipeline: DataFrame) -> DataFrame:
    """R5."""
    return pipeline.orderBy(F.desc("case_count"), "status")


def top_underpayments(detection: DataFrame, k: int = 20, eligible_only: bool = False) -> DataFrame:
    """The k largest; each task keeps its own k."""
    rows = detection.where("arbitration_eligible = 1") if eligible_only else detection
    return rows.orderBy(F.desc("underpayment_amount"), "dispute_id").limit(k)


def worst_ratios(cpt: DataFrame) -> DataFrame:
    """R12."""
    return cpt.orderBy("payment_ratio_pct", "cpt_code")


def bundle(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The reads of the dashboard by name, in display order where there is one."""
    order = {"recovery": by_underpayment, "scorecard": scorecards, "cpt": busiest_codes, "aging": aging_in_order, "pipeline": pipeline_in_order, "underpayment": top_underpayments}
    return {name: order.get(name, lambda x: x)(df) for name, df in gold.items()}


def underpaid_listing(cr: DataFrame) -> DataFrame:
    """R8."""
    return cr.where("underpayment > 0").select("claim_id", "payer_name", F.col("total_billed").cast("double").alias("total_billed"), F.col("total_paid").cast("double").alias("total_paid"), F.col("underpayment").cast("double").alias("underpayment")).orderBy(F.desc("underpayment"), "claim_id")


def denials(remits: DataFrame) -> DataFrame:
    """R9."""
    return remits.where("denial_code is not null and denial_code <> ''").select("claim_id", "trace_number", "denial_code", F.col("paid_amount").cast("double").alias("paid_amount")).orderBy("claim_id", "trace_number")


def open_deadlines(deadlines: DataFrame, as_of: str | None = None) -> DataFrame:
    """R9."""
    return deadlines.where("status in ('pending', 'alerted')").select("case_id", "deadline_type", "due_date", F.datediff("due_date", as_date(as_of)).alias("days_remaining")).orderBy("due_date", "case_id", "deadline_type")


def latest(df: DataFrame, by: str, *then: str, k: int = 20) -> DataFrame:
    """Newest rows first (audit, dead letters); rows of one time by ``then``."""
    return df.orderBy(F.desc(by), *then).limit(k)


def distribution(df: DataFrame, column: str = "status") -> DataFrame:
    """R10."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """R11."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()])
