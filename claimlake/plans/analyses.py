"""A catalogue of named analyses over gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import measures, reports

Gold = Mapping[str, DataFrame]


def recovery_opportunity(gold: Gold) -> DataFrame:
    return gold["underpayment"].groupBy("payer_id", "payer_name", "arbitration_eligible").agg(F.count("*").alias("dispute_count"), F.round(F.sum("underpayment_amount"), 2).alias("total_underpayment"), F.round(F.sum("underpayment_amount") * 0.6, 2).alias("expected_recovery"))


def denial_patterns(gold: Gold) -> DataFrame:
    return gold["scorecard"].agg(F.count("*").alias("payer_count"), F.round(F.avg("denial_rate_pct"), 2).alias("avg_denial_rate_pct"), F.round(F.corr("denial_rate_pct", "total_underpayment"), 6).alias("denial_underpayment_corr"))


CATALOGUE: dict[str, Callable[[Gold], DataFrame]] = {
    "executive_summary": lambda g: g["summary"],
    "worst_payers": lambda g: g["scorecard"].orderBy("payment_rate_pct", "payer_id").limit(5),
    "arbitration_ready": lambda g: reports.top_underpayments(g["underpayment"], 10, eligible_only=True),
    "cpt_underpayment": lambda g: reports.worst_ratios(g["cpt"]),
    "deadline_risk": lambda g: g["deadlines"].orderBy(F.desc("at_risk_count"), "deadline_type"),
    "case_pipeline": lambda g: reports.pipeline_in_order(g["pipeline"]),
    "aging_analysis": lambda g: reports.aging_in_order(g["aging"]),
    "payer_comparison": lambda g: g["scorecard"].orderBy(F.desc("payment_rate_pct"), "payer_id"),
    "recovery_opportunity": recovery_opportunity,
    "denial_patterns": denial_patterns,
    "win_loss": lambda g: g["win_loss"],
    "analyst_performance": lambda g: g["analysts"].orderBy(F.desc("win_rate_pct"), "assigned_analyst"),
    "resolution_time": lambda g: g["resolution"],
    "provider_analysis": lambda g: g["providers"].groupBy("specialty").agg(F.count("*").alias("provider_count"), F.sum("total_claims").alias("total_claims"), F.sum("total_disputes").alias("total_disputes"), F.round(F.avg("payment_rate_pct"), 2).alias("avg_payment_rate_pct")),
    "monthly_trends": lambda g: measures.month_over_month(g["months"]),
}


def run_analysis(name: str, gold: Gold) -> DataFrame:
    """The analysis of that name; an unknown name is an error that lists the known ones."""
    if name not in CATALOGUE:
        raise KeyError(f"unknown analysis {name!r}; known: {', '.join(sorted(CATALOGUE))}")
    return CATALOGUE[name](gold)
