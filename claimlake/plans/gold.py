"""Gold: business aggregates over silver tables. Many-sided inputs are summed up before they are joined."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mean, money, percent, share
from ..schemas import MONEY
from .silver import as_date


def _sum(c: str):
    return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))


def recovery_by_payer(cr: DataFrame) -> DataFrame:
    """G1."""
    ratio = F.when(F.col("total_billed") > 0, F.col("total_paid").cast("double") * 100.0 / F.col("total_billed").cast("double"))
    agg = cr.where("payer_id is not null").groupBy("payer_id").agg(
        F.max("payer_name").alias("payer_name"),
        F.count("*").alias("total_claims"),
        _sum("total_billed").alias("total_billed"),
        _sum("total_paid").alias("total_paid"),
        _sum("underpayment").alias("total_underpayment"),
        F.round(F.coalesce(F.avg(ratio), F.lit(0.0)), 2).alias("avg_payment_pct"),
        F.sum("has_denial").alias("denial_count"),
    )
    return agg.withColumn("recovery_rate_pct", percent(F.col("total_paid"), F.col("total_billed"))).withColumn("denial_rate_pct", percent(F.col("denial_count"), F.col("total_claims")))


def current_rates(fees: DataFrame, payer: str) -> DataFrame:
    """One current rate a code of ``payer``: no modifier first, then region, then id."""
    order = Window.partitionBy("cpt_code").orderBy(F.coalesce("modifier", F.lit("")), "geo_region", "id")
    return fees.where((F.col("payer_id") == payer) & (F.col("is_current") == 1)).withColumn("_n", F.row_number().over(order)).where("_n = 1").select("cpt_code", F.col("rate").cast("double").alias("rate"))


def cpt_analysis(claims: DataFrame, cr: DataFrame, fees: DataFrame | None = None) -> DataFrame:
    """Each claim's sums split evenly over its codes (shares to a millionth), beside benchmark rates."""
    paid = cr.select("claim_id", "total_paid")
    n, zero = F.size("cpt_codes"), F.lit(0).cast("decimal(18,2)")
    split = claims.where(n > 0).join(paid, "claim_id", "left").select(F.explode("cpt_codes").alias("cpt_code"), share(F.col("total_billed"), n).alias("b"), share(F.coalesce("total_paid", zero), n).alias("p"))
    rows, cents = F.count("*"), lambda c: F.round(F.sum(c), 2).cast("double")
    out = split.groupBy("cpt_code").agg(
        rows.alias("claim_count"), cents("b").alias("total_billed"), cents("p").alias("total_paid"), mean(F.sum("b"), rows).alias("avg_billed"), mean(F.sum("p"), rows).alias("avg_paid")
    ).withColumn("payment_ratio_pct", percent(F.col("total_paid"), F.col("total_billed")))
    if fees is None:
        return out
    for payer, name in (("MEDICARE", "medicare_rate"), ("FAIR_HEALTH", "fair_health_rate")):
        out = out.join(current_rates(fees, payer).withColumnRenamed("rate", name), "cpt_code", "left")
    return out


def cpt_line_level(lines: DataFrame, cr: DataFrame) -> DataFrame:
    """Real line amounts; a claim's payment is shared by its lines."""
    n = lines.groupBy("claim_id").agg(F.count("*").alias("n"))
    paid = cr.select("claim_id", "total_paid").join(n, "claim_id").select("claim_id", share(F.col("total_paid"), F.col("n")).alias("paid"))
    total = F.coalesce(F.round(F.sum("paid"), 2).cast("double"), F.lit(0.0))
    return lines.join(paid, "claim_id", "left").groupBy("cpt_code").agg(F.countDistinct("claim_id").alias("claim_count"), _sum("billed_amount").alias("total_billed"), total.alias("total_paid"))


def payer_scorecard(cr: DataFrame, payers: DataFrame) -> DataFrame:
    """G3."""
    agg = cr.where("payer_id is not null").groupBy("payer_id").agg(
        F.max("payer_name").alias("payer_name"),
        F.count("*").alias("total_claims"),
        percent(F.sum("total_paid"), F.sum("total_billed")).alias("payment_rate_pct"),
        percent(F.sum("has_denial"), F.count("*")).alias("denial_rate_pct"),
        mean(F.sum("underpayment"), F.count("underpayment")).alias("avg_underpayment"),
        _sum("underpayment").alias("total_underpayment"),
    )
    tier = F.when((F.col("payment_rate_pct") >= 80) & (F.col("denial_rate_pct") <= 10), "low").when((F.col("payment_rate_pct") >= 50) | (F.col("denial_rate_pct") <= 30), "medium").otherwise("high")
    return agg.withColumn("risk_tier", tier).join(payers.select("payer_id", F.col("type").alias("payer_type")), "payer_id", "left").withColumn("avg_days_to_pay", F.lit(None).cast("double"))


def days_to_pay(claims: DataFrame, remits: DataFrame) -> DataFrame:
    """Average days from service to remittance by payer."""
    return claims.join(remits.select("claim_id", "era_date"), "claim_id").groupBy("payer_id").agg(F.round(F.avg(F.datediff("era_date", "date_of_service")), 2).alias("avg_days_to_pay"), F.count("*").alias("remittance_count"))


# Metrics in their order.
METRICS = ["total_claims", "total_billed", "total_paid", "total_underpayment", "recovery_rate_pct", "paid_claims", "denial_count", "denial_rate_pct", "avg_billed_per_claim", "avg_underpayment_per_claim"]


def financial_summary(cr: DataFrame) -> DataFrame:
    """Ten metrics as rows, from one global aggregation."""
    n = F.count("*")
    one = cr.agg(
        n.cast("double").alias("total_claims"),
        _sum("total_billed").alias("total_billed"),
        _sum("total_paid").alias("total_paid"),
        _sum("underpayment").alias("total_underpayment"),
        percent(F.sum("total_paid"), F.sum("total_billed")).alias("recovery_rate_pct"),
        F.count_if(F.col("total_paid") > 0).cast("double").alias("paid_claims"),
        F.coalesce(F.sum("has_denial"), F.lit(0)).cast("double").alias("denial_count"),
        percent(F.sum("has_denial"), n).alias("denial_rate_pct"),
        F.coalesce(mean(F.sum("total_billed"), n), F.lit(0.0)).alias("avg_billed_per_claim"),
        F.coalesce(mean(F.sum("underpayment"), n), F.lit(0.0)).alias("avg_underpayment_per_claim"),
    )
    return one.unpivot([], METRICS, "metric_name", "metric_value")


BUCKETS = ["0-30 days", "31-60 days", "61-90 days", "91-180 days", "180+ days"]


def claims_aging(cr: DataFrame, as_of: str | None = None) -> DataFrame:
    """Claims by age in whole days; undated ones are left out."""
    age = F.datediff(as_date(as_of), F.col("date_of_service"))
    bucket = F.when(age <= 30, BUCKETS[0]).when(age <= 60, BUCKETS[1]).when(age <= 90, BUCKETS[2]).when(age <= 180, BUCKETS[3]).otherwise(BUCKETS[4])
    agg = cr.where("date_of_service is not null").groupBy(bucket.alias("aging_bucket")).agg(F.count("*").alias("claim_count"), _sum("total_billed").alias("total_billed"), _sum("underpayment").alias("total_unpaid"))
    return agg.withColumn("pct_of_total", F.round(F.col("claim_count") * 100.0 / F.sum("claim_count").over(Window.partitionBy()), 2))  # five rows


def case_pipeline(cases: DataFrame, deadlines: DataFrame) -> DataFrame:
    """G6."""
    agg = cases.groupBy("status").agg(F.count("*").alias("case_count"), _sum("total_billed").alias("total_billed"), _sum("total_underpayment").alias("total_underpayment"), F.round(F.avg("age_days"), 1).alias("avg_age_days"))
    met = deadlines.groupBy("case_id").agg(F.count("*").alias("d"), F.count_if(F.col("status") == "met").alias("m"))
    sla = cases.select("case_id", F.col("status").alias("s")).join(met, "case_id").groupBy("s").agg(percent(F.sum("m"), F.sum("d")).alias("sla"))
    return agg.join(sla, F.col("status") == F.col("s"), "left").select("status", "case_count", "total_billed", "total_underpayment", "avg_age_days", F.coalesce("sla", F.lit(0.0)).alias("sla_compliance_pct"))


def deadline_compliance(deadlines: DataFrame) -> DataFrame:
    """Over silver deadlines."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    return deadlines.groupBy("deadline_type").agg(
        F.count("*").alias("total_deadlines"), is_("met").alias("met_count"), is_("missed").alias("missed_count"), is_("pending").alias("pending_count"), F.sum("is_at_risk").alias("at_risk_count"), percent(is_("met"), F.count("*")).alias("compliance_pct")
    )


def underpayment_detection(disputes: DataFrame) -> DataFrame:
    """One row a dispute with underpayment, and whether it may go to arbitration."""
    pct = percent(F.col("underpayment_amount"), F.col("billed_amount"))
    eligible = ((pct > 25) & (F.col("billed_amount") > F.coalesce("qpa_amount", F.lit(0).cast("decimal(18,2)")))).cast("int")
    return disputes.where("underpayment_amount > 0").select(
        "dispute_id",
        "claim_id",
        "case_id",
        "payer_id",
        "payer_name",
        "dispute_type",
        F.col("billed_amount").cast("double").alias("billed_amount"),
        F.col("paid_amount").cast("double").alias("paid_amount"),
        F.col("underpayment_amount").cast("double").alias("underpayment_amount"),
        pct.alias("underpayment_pct"),
        F.col("qpa_amount").cast("double").alias("qpa_amount"),
        eligible.alias("arbitration_eligible"),
    )


def win_loss(cases: DataFrame, disputes: DataFrame) -> DataFrame:
    """Outcomes of resolved cases; the win rate is over all outcomes of a payer and dispute type."""
    rows = cases.where(F.col("status").isin("decided", "closed")).select("case_id", "outcome", F.coalesce(money("award_amount"), F.lit(0).cast(MONEY)).alias("award")).join(disputes.drop("outcome", "award"), "case_id")
    agg = rows.groupBy("payer_id", "payer_name", "dispute_type", "outcome").agg(
        F.count("*").alias("case_count"), _sum("billed_amount").alias("total_billed"), _sum("underpayment_amount").alias("total_disputed"), _sum("award").alias("total_awarded"), mean(F.sum("award"), F.count("*")).alias("avg_award")
    )
    group = Window.partitionBy("payer_id", "dispute_type")
    won = F.sum(F.when(F.col("outcome") == "won", F.col("case_count")).otherwise(0)).over(group)
    return agg.withColumn("win_rate_pct", percent(won, F.sum("case_count").over(group))).withColumn("recovery_roi_pct", percent(F.col("total_awarded"), F.col("total_disputed")))


def _per_case(disputes: DataFrame) -> DataFrame:
    return disputes.groupBy("case_id").agg(F.sum("underpayment_amount").alias("disputed"))


def analyst_productivity(cases: DataFrame, disputes: DataFrame) -> DataFrame:
    """G10."""
    done = F.col("status").isin("closed", "decided")
    won = F.count_if(F.col("outcome") == "won")
    return cases.select("case_id", "assigned_analyst", "status", "outcome", "priority", "created_date", "closed_date", money("award_amount").alias("award")).join(_per_case(disputes), "case_id", "left").groupBy("assigned_analyst").agg(
        F.count("*").alias("total_cases"),
        F.count_if(~done).alias("active_cases"),
        F.count_if(done).alias("resolved_cases"),
        won.alias("won_cases"),
        F.count_if(F.col("outcome") == "lost").alias("lost_cases"),
        F.count_if(F.col("outcome") == "settled").alias("settled_cases"),
        percent(won, F.count_if(done)).alias("win_rate_pct"),
        _sum("award").alias("total_recovered"),
        _sum("disputed").alias("total_disputed"),
        F.round(F.avg(F.datediff("closed_date", "created_date")), 1).alias("avg_resolution_days"),
        F.count_if(F.col("priority") == "critical").alias("critical_cases"),
        F.count_if(F.col("priority") == "high").alias("high_priority_cases"),
    )


def time_to_resolution(cases: DataFrame, disputes: DataFrame, as_of: str | None = None) -> DataFrame:
    """G11."""
    days = F.datediff(F.coalesce("closed_date", as_date(as_of)), F.col("created_date"))
    return cases.select("case_id", "status", "priority", "outcome", days.alias("days"), money("award_amount").alias("award")).join(_per_case(disputes), "case_id", "left").groupBy("status", "priority").agg(
        F.count("*").alias("case_count"),
        F.round(F.avg("days"), 1).alias("avg_days"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
        _sum("disputed").alias("total_at_stake"),
        _sum("award").alias("total_recovered"),
        percent(F.count_if(F.col("outcome") == "won"), F.count("*")).alias("win_rate_pct"),
    )


def provider_performance(providers: DataFrame, cr: DataFrame, disputes: DataFrame, cases: DataFrame) -> DataFrame:
    """Claims, disputes and awards are summed up by provider on their own, then joined."""
    claims = cr.groupBy(F.col("provider_npi").alias("npi")).agg(F.countDistinct("claim_id").alias("total_claims"), _sum("total_billed").alias("total_billed"), _sum("total_paid").alias("total_paid"), _sum("underpayment").alias("total_underpayment"))
    argued = disputes.groupBy(F.col("provider_npi").alias("npi")).agg(F.countDistinct("dispute_id").alias("total_disputes"))
    award = disputes.select("case_id", F.col("provider_npi").alias("npi")).distinct().join(cases.select("case_id", money("award_amount").alias("award")), "case_id").groupBy("npi").agg(F.sum("award").alias("won"))
    return (
        providers.join(claims, "npi")
        .join(argued, "npi", "left")
        .join(award, "npi", "left")
        .select(
            F.col("npi").alias("provider_npi"),
            F.col("name").alias("provider_name"),
            "specialty",
            "total_claims",
            F.coalesce("total_disputes", F.lit(0)).alias("total_disputes"),
            "total_billed",
            "total_paid",
            "total_underpayment",
            percent(F.col("total_paid"), F.col("total_billed")).alias("payment_rate_pct"),
            percent(F.coalesce("total_disputes", F.lit(0)), F.col("total_claims")).alias("dispute_rate_pct"),
            F.coalesce("won", F.lit(0.0)).alias("total_recovered"),
        )
    )


def monthly_trends(cr: DataFrame, disputes: DataFrame, cases: DataFrame) -> DataFrame:
    """Each event in its own month; months are those of any of them."""
    month = lambda c: F.date_format(c, "yyyy-MM").alias("month")
    a = cr.where("date_of_service is not null").groupBy(month("date_of_service")).agg(
        F.count("*").alias("claim_count"), F.sum("total_billed").cast("double").alias("total_billed"), F.sum("total_paid").cast("double").alias("total_paid"), F.sum("underpayment").cast("double").alias("total_underpayment"), F.sum("has_denial").alias("denial_count")
    )
    b = disputes.where("filed_date is not null").groupBy(month("filed_date")).agg(F.count("*").alias("new_disputes"))
    c = cases.where("closed_date is not null and status in ('closed', 'decided')").groupBy(month("closed_date")).agg(F.count("*").alias("resolved_cases"), F.sum(money("award_amount")).cast("double").alias("total_awarded"))
    out = a.join(b, "month", "full_outer").join(c, "month", "full_outer").fillna(0)
    return out.withColumn("recovery_rate_pct", percent(F.col("total_paid"), F.col("total_billed")))


def run_all(builders: dict[str, Callable[[], DataFrame]], write: Callable[[str, DataFrame], object] | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Every aggregate that can be built and, with ``write`` (name, frame), run; and the error of those that can't.

    A plan mostly fails at its action, so the writing is what isolates one table's trouble from the others.
    """
    out, failed = {}, {}
    for name, build in builders.items():
        try:
            df = build()
            if write is not None:
                write(name, df)
            out[name] = df
        except Exception as error:
            failed[name] = f"{type(error).__name__}: {error}"
    return out, failed
