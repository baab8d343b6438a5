"""Disputes, cases and deadlines derived from mapped claims by the workflow's own steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import silver, workflow
from .mapped import AS_OF, Mapped

# The statuses that stand-in cases take by claim number.
STATUSES = ["open", "in_review", "negotiation", "idr_initiated", "idr_submitted", "decided", "closed"]
OUTCOMES = ["won", "lost", "settled"]


def disputes(m: Mapped) -> DataFrame:
    filed = F.expr("date_add(date_of_service, cast(claim_id % 60 as int))")
    return workflow.open_disputes(workflow.underpaid_claims(m.claims(), m.remittances()), filed).join(m.payers().select("payer_id", F.col("name").alias("payer_name")), "payer_id", "left")


def cases(m: Mapped) -> DataFrame:
    base = workflow.open_cases(disputes(m), ("underpayment_amount",)).withColumn("n", F.substring("case_id", 6, 20).cast("long"))
    status = F.element_at(F.array(*map(F.lit, STATUSES)), (F.col("n") % 7 + 1).cast("int"))
    done = status.isin("decided", "closed")
    outcome = F.when(done & (F.col("n") % 4 < 3), F.element_at(F.array(*map(F.lit, OUTCOMES)), (F.least(F.col("n") % 4, F.lit(2)) + 1).cast("int")))
    return base.select(
        "case_id",
        "assigned_analyst",
        status.alias("status"),
        "priority",
        "created_date",
        F.expr("date_add(created_date, cast(n % 30 as int))").alias("last_activity_date"),
        F.when(done, F.expr("date_add(created_date, cast(30 + n % 90 as int))")).alias("closed_date"),
        outcome.alias("outcome"),
        F.when(outcome == "won", F.col("underpayment_amount")).alias("award_amount"),
    )


def deadlines(m: Mapped) -> DataFrame:
    n = F.substring("case_id", 6, 20).cast("long") % 5
    return workflow.make_deadlines(disputes(m)).withColumn("status", F.when(n == 0, "met").when(n == 1, "missed").otherwise("pending"))


def claim_remittance(m: Mapped) -> DataFrame:
    return silver.claim_remittance(m.claims(), m.remittances(), m.payers())


def silver_cases(m: Mapped) -> DataFrame:
    return silver.cases(cases(m), disputes(m), AS_OF)


def silver_deadlines(m: Mapped) -> DataFrame:
    return silver.deadlines(deadlines(m), AS_OF)
