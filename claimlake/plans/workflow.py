"""Dispute workflow as set-based batch steps over claims, cases, disputes and deadlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import money
from ..schemas import DEADLINE_DAYS, DEFAULT_DEADLINES, TRANSITIONS
from .silver import as_date

# The analyst who gets the cases of each priority, and deadline types whose miss makes a case critical.
ANALYST_OF = {"high": "analyst_kpatel", "medium": "analyst_mchen", "low": "analyst_jsmith"}
CRITICAL_TYPES = ["idr_initiation", "idr_decision", "evidence_submission"]


def underpaid_claims(claims: DataFrame, remits: DataFrame, disputes: DataFrame | None = None) -> DataFrame:
    """Claims paid less than billed that no dispute covers yet."""
    paid = remits.groupBy("claim_id").agg(F.sum("paid_amount").alias("paid"), F.sum("allowed_amount").alias("allowed"))
    zero = F.lit(0).cast("decimal(18,2)")
    out = claims.join(paid, "claim_id", "left").withColumns({"paid": money(F.coalesce("paid", zero)), "allowed": money(F.coalesce("allowed", zero))}).where("total_billed > paid")
    return out if disputes is None else out.join(disputes.select("claim_id"), "claim_id", "left_anti")


def priority(underpayment: Column) -> Column:
    return F.when(underpayment > 500, "high").when(underpayment > 200, "medium").otherwise("low")


def open_disputes(underpaid: DataFrame, filed: Column) -> DataFrame:
    """A dispute for each underpaid claim; its case has the same suffix. Ids derive from the claim's."""
    gap = F.col("total_billed") - F.col("paid")
    key = F.col("claim_id").cast("string")
    return underpaid.select(
        F.concat(F.lit("DSP-"), key).alias("dispute_id"),
        "claim_id",
        F.concat(F.lit("CASE-"), key).alias("case_id"),
        F.when(F.col("paid") > 0, "underpayment").otherwise("denial").alias("dispute_type"),
        "payer_id",
        "provider_npi",
        F.col("total_billed").alias("billed_amount"),
        F.col("paid").alias("paid_amount"),
        money(gap).alias("underpayment_amount"),
        money(F.when(F.col("allowed") > 0, F.col("allowed")).otherwise(F.round(F.col("total_billed") * F.lit("0.6").cast("decimal(4,2)"), 2))).alias("qpa_amount"),
        filed.alias("filed_date"),
        F.date_add(filed, 30).alias("open_negotiation_deadline"),
        F.date_add(filed, 34).alias("idr_initiation_deadline"),
    )


def open_cases(disputes: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The new cases of new disputes, with columns of these to ``carry``; the priority says who gets a case."""
    level = priority(F.col("underpayment_amount"))
    analyst = F.lit(None).cast("string")
    for name, who in ANALYST_OF.items():
        analyst = F.when(level == name, who).otherwise(analyst)
    return disputes.select("case_id", analyst.alias("assigned_analyst"), F.lit("open").alias("status"), level.alias("priority"), F.col("filed_date").alias("created_date"), *carry)


def mark_in_dispute(claims: DataFrame, disputes: DataFrame) -> DataFrame:
    """Claims with a dispute have the status ``in_dispute``."""
    argued = disputes.select("claim_id").distinct().withColumn("_argued", F.lit(True))
    return claims.join(argued, "claim_id", "left").withColumn("status", F.when(F.col("_argued"), F.lit("in_dispute")).otherwise(F.col("status"))).drop("_argued")


def make_deadlines(disputes: DataFrame, types: list[str] | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Regulatory deadlines of each dispute, those that exist already aside."""
    days = F.create_map(*[x for t in types or DEFAULT_DEADLINES for x in (F.lit(t), F.lit(DEADLINE_DAYS[t]))])
    out = disputes.select("case_id", "dispute_id", "filed_date", F.explode(days).alias("deadline_type", "days")).select(
        "case_id", "dispute_id", "deadline_type", F.expr("date_add(filed_date, days)").alias("due_date"), F.lit("pending").alias("status")
    )
    return out if existing is None else out.join(existing.select("case_id", "dispute_id", "deadline_type"), ["case_id", "dispute_id", "deadline_type"], "left_anti")


def at_risk(deadlines: DataFrame, cases: DataFrame, as_of: str | None = None, days: int = 5) -> DataFrame:
    """Pending deadlines due from today up to ``days`` on, with the case's analyst."""
    today = as_date(as_of)
    due = (F.col("status") == "pending") & F.col("due_date").between(today, F.date_add(today, days))
    return deadlines.where(due).join(cases.select("case_id", "assigned_analyst", "priority"), "case_id").withColumn("days_remaining", F.datediff("due_date", today))


def mark_missed(deadlines: DataFrame, as_of: str | None = None) -> DataFrame:
    """Pending deadlines before today become missed."""
    return deadlines.withColumn("status", F.when((F.col("status") == "pending") & (F.col("due_date") < as_date(as_of)), "missed").otherwise(F.col("status")))


def mark_alerted(deadlines: DataFrame, alerts: DataFrame, as_of: str | None = None) -> DataFrame:
    """Deadlines with an alert pass from pending to alerted."""
    hit = alerts.select("case_id", "dispute_id", "deadline_type").distinct().withColumn("_hit", F.lit(True))
    now = F.col("_hit") & (F.col("status") == "pending")
    return deadlines.join(hit, ["case_id", "dispute_id", "deadline_type"], "left").withColumns({"alerted_date": F.when(now, as_date(as_of)), "status": F.when(now, "alerted").otherwise(F.col("status"))}).drop("_hit")


def escalate(cases: DataFrame, missed: DataFrame) -> DataFrame:
    """Cases that missed a critical deadline become critical."""
    late = missed.where(F.col("deadline_type").isin(CRITICAL_TYPES) & (F.col("status") == "missed")).select("case_id").distinct().withColumn("_late", F.lit(True))
    return cases.join(late, "case_id", "left").withColumn("priority", F.when(F.col("_late"), F.lit("critical")).otherwise(F.col("priority"))).drop("_late")


def monitor(deadlines: DataFrame, cases: DataFrame, as_of: str | None = None) -> DataFrame:
    """Counts of one monitoring run, as one row."""
    today = as_date(as_of)
    pending = F.col("status") == "pending"
    late = pending & (F.col("due_date") < today)
    soon = pending & F.col("due_date").between(today, F.date_add(today, 5))
    rows = deadlines.join(cases.select("case_id"), "case_id", "left_semi")
    return rows.agg(
        F.count_if(soon).alias("at_risk"), F.count_if(late).alias("missed"), F.countDistinct(F.when(late & F.col("deadline_type").isin(CRITICAL_TYPES), F.col("case_id"))).alias("escalated"), F.count_if(soon | late).alias("alerts")
    )


def transition_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, b) for a, to in TRANSITIONS.items() for b in to], "status string, target_status string")


def judge_transitions(requests: DataFrame, cases: DataFrame) -> DataFrame:
    """Each request (case_id, target_status and, if there is one, arrival) with ``valid`` and, if it isn't, a reason.

    The requests of a case are taken in order of arrival (then of target): a valid one changes the status
    that the next one meets.
    """
    allowed = F.create_map(*[x for a, to in TRANSITIONS.items() for x in (F.lit(a), F.array(*map(F.lit, to)))])
    at = F.col("arrival") if "arrival" in requests.columns else F.lit(0)
    wanted = requests.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct(at.alias("arrival"), "target_status"))).alias("wanted"))
    known = wanted.join(cases.select("case_id", F.col("status")), "case_id", "left")
    none = F.array().cast("array<struct<current_status:string,target_status:string,valid:boolean>>")

    def take(state: Column, request: Column) -> Column:
        ok = F.coalesce(F.array_contains(F.try_element_at(allowed, state["status"]), request["target_status"]), F.lit(False))
        judged = F.struct(state["status"].alias("current_status"), request["target_status"].alias("target_status"), ok.alias("valid"))
        return F.struct(F.when(ok, request["target_status"]).otherwise(state["status"]).alias("status"), F.concat(state["judged"], F.array(judged)).alias("judged"))

    start = F.struct(F.col("status").alias("status"), none.alias("judged"))
    out = known.select("case_id", F.posexplode(F.aggregate("wanted", start, take)["judged"]).alias("step", "j")).select("case_id", "step", "j.*")
    names = F.array_join(F.try_element_at(allowed, F.col("current_status")), ", ")
    why = F.when(F.col("current_status").isNull(), F.concat(F.lit("Case "), F.col("case_id"), F.lit(" not found"))).when(
        ~F.col("valid"), F.concat(F.lit("Cannot transition from "), F.col("current_status"), F.lit(" to "), F.col("target_status"), F.lit("; allowed: "), F.coalesce(names, F.lit("none")))
    )
    return out.select("case_id", "step", "current_status", "target_status", "valid", why.alias("reason"))


def _reached(judged: DataFrame) -> DataFrame:
    """The last status of each case that has a valid request, and all that it passed."""
    return judged.where("valid").groupBy("case_id").agg(F.max_by("target_status", "step").alias("_to"), F.collect_set("target_status").alias("_passed"))


def apply_transitions(cases: DataFrame, judged: DataFrame, as_of: str | None = None) -> DataFrame:
    """Cases after the valid requests, in their order."""
    today = as_date(as_of)
    moved = F.col("_to").isNotNull()
    return cases.join(_reached(judged), "case_id", "left").withColumns({"status": F.coalesce("_to", "status"), "last_activity_date": F.when(moved, today).otherwise(F.col("last_activity_date")), "closed_date": F.when(F.col("_to") == "closed", today).otherwise(F.col("closed_date"))}).drop("_to", "_passed")


# The deadline type that reaching a status completes.
COMPLETES = {"negotiation": "open_negotiation", "idr_initiated": "idr_initiation", "decided": "idr_decision"}


def transition_deadlines(deadlines: DataFrame, disputes: DataFrame, judged: DataFrame, as_of: str | None = None) -> DataFrame:
    """Deadlines after the valid requests: those completed are met, closing meets all open ones, and
    initiated arbitration adds its evidence deadline."""
    go = _reached(judged)
    done = F.create_map(*[x for s, t in COMPLETES.items() for x in (F.lit(s), F.lit(t))])
    completed = F.exists(F.col("_passed"), lambda s: F.coalesce(F.try_element_at(done, s) == F.col("deadline_type"), F.lit(False)))
    joined = deadlines.join(go, "case_id", "left")
    meets = F.coalesce(F.col("status").isin("pending", "alerted") & (F.array_contains("_passed", "closed") | completed), F.lit(False))
    changed = joined.withColumn("status", F.when(meets, "met").otherwise(F.col("status"))).drop("_to", "_passed")
    started = disputes.join(go.where(F.array_contains("_passed", "idr_initiated")).select("case_id"), "case_id", "left_semi")
    return changed.unionByName(make_deadlines(started, ["evidence_submission"], deadlines), allowMissingColumns=True)


def deadline_status(due: Column, resolved: Column, as_of: str | None = None) -> Column:
    """W10."""
    today = as_date(as_of)
    return F.when(resolved, "met").when(due < today, "missed").when(F.datediff(due, today) <= 5, "at_risk").otherwise("pending")


def metric_alerts(dlq: DataFrame, claims_in: int, confidence: DataFrame) -> DataFrame:
    """One row a metric over its threshold: DLQ depth, parse failures, unmatched references, confidence."""
    total = F.lit(float(max(1, claims_in)))
    one = dlq.agg(
        F.count_if(F.col("status") == "pending").cast("double").alias("dlq_depth"),
        (F.count_if(F.col("error_category") == "parse_failure") * 100.0 / total).alias("parse_failure_pct"),
        (F.count_if(F.col("error_category") == "unmatched_reference") * 100.0 / total).alias("unmatched_pct"),
    ).unpivot([], ["dlq_depth", "parse_failure_pct", "unmatched_pct"], "metric", "value")
    conf = confidence.agg(F.avg(F.col("confidence") * 100.0).alias("value")).select(F.lit("avg_confidence_pct").alias("metric"), "value")
    limit = F.when(F.col("metric") == "dlq_depth", 50.0).when(F.col("metric") == "parse_failure_pct", 5.0).when(F.col("metric") == "unmatched_pct", 10.0).otherwise(85.0)
    over = F.when(F.col("metric") == "avg_confidence_pct", F.col("value") < limit).otherwise(F.col("value") > limit)
    return one.unionByName(conf).select("metric", "value", limit.alias("threshold"), F.coalesce(over, F.lit(False)).alias("alert"))


# Metrics by window, with the window's width, the threshold and whether a value below it alerts.
WINDOW_LIMITS = {
    "claims_per_hour": ("1 hour", 10.0, True),
    "era_per_day": ("1 day", 1.0, True),
    "parse_failure_pct": ("1 hour", 5.0, False),
    "unmatched_pct": ("1 day", 10.0, False),
    "avg_confidence_pct": ("1 day", 85.0, True),
}


def windowed_alerts(events: DataFrame, open_from: int = 0, open_to: int = 24) -> DataFrame:
    """W11 by window: metric, window_start, value and alert, from rows (at, kind, failed, confidence).

    ``kind`` is claim, message (``failed``: it couldn't be parsed), era (``failed``: without a claim) or document
    (with ``confidence``). Counts are asked of each window between the first and the last row of their kind, so one
    without rows counts 0; claims an hour only of hours from ``open_from`` up to ``open_to``. Shares and means
    are of windows with rows.
    """
    w = lambda width: F.window("at", width)["start"].alias("window_start")
    out = None
    for metric, kind in (("claims_per_hour", "claim"), ("era_per_day", "era")):
        width = WINDOW_LIMITS[metric][0]
        have = events.where(F.col("kind") == kind).groupBy(w(width)).agg(F.count("*").cast("double").alias("n"))
        span = have.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b")).where("a is not null")
        every = span.select(F.explode(F.expr(f"sequence(a, b, interval {width})")).alias("window_start"))
        rows = every.join(have, "window_start", "left").select(F.lit(metric).alias("metric"), "window_start", F.coalesce("n", F.lit(0.0)).alias("value"))
        if metric == "claims_per_hour":
            rows = rows.where((F.hour("window_start") >= open_from) & (F.hour("window_start") < open_to))
        out = rows if out is None else out.unionByName(rows)
    shares = {"parse_failure_pct": ("message", F.count_if("failed") * 100.0 / F.count("*")), "unmatched_pct": ("era", F.count_if("failed") * 100.0 / F.count("*")), "avg_confidence_pct": ("document", F.avg("confidence") * 100.0)}
    for metric, (kind, value) in shares.items():
        rows = events.where(F.col("kind") == kind).groupBy(w(WINDOW_LIMITS[metric][0])).agg(F.round(value, 4).alias("value"))
        out = out.unionByName(rows.select(F.lit(metric).alias("metric"), "window_start", "value"))
    alert = F.lit(False)
    for metric, (_, limit, below) in WINDOW_LIMITS.items():
        alert = F.when(F.col("metric") == metric, (F.col("value") < limit) if below else (F.col("value") > limit)).otherwise(alert)
    return out.withColumn("alert", F.coalesce(alert, F.lit(False)))
