"""BI measures over gold tables, each a frame of one row (or one a group)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))


def _if(cond: Column, c: str) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(c))).cast("double"), F.lit(0.0))


def kpis(summary: DataFrame) -> DataFrame:
    """A1: seven metrics of the key-value summary as columns."""
    pick = lambda n: F.max(F.when(F.col("metric_name") == n, F.col("metric_value"))).alias(n)
    return summary.agg(*map(pick, ["total_billed", "total_paid", "total_underpayment", "recovery_rate_pct", "denial_rate_pct", "total_claims", "avg_billed_per_claim"]))


def status_labels(scorecard: DataFrame) -> DataFrame:
    """A2: colour of the risk tier and label of the recovery rate."""
    colour = F.when(F.col("risk_tier") == "high", "red").when(F.col("risk_tier") == "medium", "amber").otherwise("green")
    label = F.when(F.col("payment_rate_pct") >= 80, "good").when(F.col("payment_rate_pct") >= 50, "fair").otherwise("poor")
    return scorecard.select("payer_id", "risk_tier", colour.alias("risk_colour"), "payment_rate_pct", label.alias("recovery_status"))


def sla_labels(pipeline: DataFrame) -> DataFrame:
    """A2: label of SLA compliance."""
    return pipeline.select("status", "sla_compliance_pct", F.when(F.col("sla_compliance_pct") >= 90, "good").when(F.col("sla_compliance_pct") >= 70, "fair").otherwise("poor").alias("sla_status"))


def payer_risk(scorecard: DataFrame) -> DataFrame:
    """A3."""
    high = F.col("risk_tier") == "high"
    return scorecard.agg(F.countDistinct("payer_id").alias("payer_count"), F.count_if(high).alias("high_risk_count"), _if(high, "total_underpayment").alias("revenue_at_risk"))


def weighted_recovery(recovery: DataFrame) -> DataFrame:
    """A4."""
    return recovery.agg(percent(F.sum("total_paid"), F.sum("total_billed")).alias("weighted_recovery_pct"), (_total("total_billed") - _total("total_paid")).alias("net_underpayment"))


def cpt_efficiency(cpt: DataFrame) -> DataFrame:
    """A5."""
    gap = F.avg(F.when(F.col("medicare_rate").isNotNull(), F.col("avg_paid") - F.col("medicare_rate")))
    return cpt.agg(percent(F.sum("total_paid"), F.sum("total_billed")).alias("payment_efficiency_pct"), F.round(gap, 2).alias("avg_medicare_gap"))


def aged_claims(aging: DataFrame) -> DataFrame:
    """A6."""
    old = F.col("aging_bucket").isin("91-180 days", "180+ days")
    return aging.agg(percent(_if(old, "claim_count"), F.sum("claim_count")).alias("over_90_pct"), _if(old, "total_unpaid").alias("unpaid_aged_total"))


def pipeline_value(pipeline: DataFrame) -> DataFrame:
    """A7."""
    active = ~F.col("status").isin("closed", "decided")
    return pipeline.agg(_if(active, "case_count").cast("long").alias("active_cases"), _if(active, "total_underpayment").alias("pipeline_value"), F.round(F.avg("sla_compliance_pct"), 2).alias("avg_sla_pct"))


def overall_compliance(compliance: DataFrame) -> DataFrame:
    """A8."""
    return compliance.agg(percent(F.sum("met_count"), F.sum("total_deadlines")).alias("compliance_pct"), F.sum("at_risk_count").alias("total_at_risk"), F.sum("missed_count").alias("total_missed"))


def arbitration(detection: DataFrame) -> DataFrame:
    """A9."""
    ok = F.col("arbitration_eligible") == 1
    return detection.agg(F.count_if(ok).alias("eligible_count"), _if(ok, "underpayment_amount").alias("eligible_value"), F.round(F.avg("underpayment_pct"), 2).alias("avg_underpayment_pct"))


def outcomes(win_loss: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A10: over all, or by dispute type."""
    won = _if(F.col("outcome") == "won", "case_count")
    return win_loss.groupBy(*(by or [])).agg(
        percent(won, F.sum("case_count")).alias("win_rate_pct"), _total("total_awarded").alias("total_awarded"), percent(F.sum("total_awarded"), F.sum("total_disputed")).alias("roi_pct"), F.round(_total("total_awarded") / F.sum("case_count"), 2).alias("avg_award")
    )


def productivity(analysts: DataFrame) -> DataFrame:
    """A11."""
    return analysts.agg(
        F.sum("active_cases").alias("active_cases"),
        F.sum("resolved_cases").alias("resolved_cases"),
        F.round(F.avg("avg_resolution_days"), 1).alias("avg_resolution_days"),
        percent(F.sum("won_cases"), F.sum("resolved_cases")).alias("win_rate_pct"),
        _total("total_recovered").alias("total_recovered"),
        percent(F.sum("resolved_cases"), F.sum("total_cases")).alias("resolution_pct"),
    )


def resolution(times: DataFrame) -> DataFrame:
    """A12."""
    return times.where(F.col("status").isin("closed", "decided")).agg(F.round(F.avg("avg_days"), 1).alias("avg_resolution_days"), _total("total_at_stake").alias("value_at_stake"))


def providers(performance: DataFrame) -> DataFrame:
    """A13."""
    return performance.agg(F.round(F.avg("dispute_rate_pct"), 2).alias("avg_dispute_rate_pct"), F.max("total_recovered").alias("top_recovery"))


def month_over_month(trends: DataFrame) -> DataFrame:
    """Growth of claims against the month before; a few hundred rows, one window."""
    before = F.lag("claim_count").over(Window.orderBy("month"))
    return trends.select("month", "claim_count", "new_disputes", "resolved_cases", "recovery_rate_pct", F.when(before > 0, F.round((F.col("claim_count") - before) * 100.0 / before, 2)).alias("growth_pct"))


def forecast(detection: DataFrame) -> DataFrame:
    """A15."""
    value = _if(F.col("arbitration_eligible") == 1, "underpayment_amount")
    return detection.agg(F.round(value * 0.60, 2).alias("expected_low"), F.round(value * 0.80, 2).alias("expected_high"), F.round(value * 0.60 * 0.85, 2).alias("net_recovery"))
