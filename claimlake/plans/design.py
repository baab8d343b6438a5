"""Operators that the domain's design documents ask for beyond the coded ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mean, money, percent
from ..operators.merge import as_of_lookup, snapshot_diff, upsert
from ..operators.selection import exact_median
from .silver import as_date


def expected_vs_paid(lines: DataFrame, history: DataFrame, keys: list[str], paid: str, tolerance: float = 0.01) -> DataFrame:
    """Contract rate on the date of service against what was paid: dispute, close, or no rate."""
    priced = as_of_lookup(lines, history, keys, "date_of_service", "rate")
    gap = F.col("rate").cast("double") - F.col(paid).cast("double")
    return priced.withColumn("decision", F.when(F.col("rate").isNull(), "no_rate").when(gap > F.col("rate").cast("double") * tolerance, "dispute").otherwise("close"))


def recovery_potential(open_disputes: DataFrame, decided: DataFrame, by: list[str], least: float = 100.0) -> DataFrame:
    """Amount times the historical win rate of its group; small ones go to review."""
    rate = decided.groupBy(*by).agg((F.count_if(F.col("outcome") == "won") / F.count("*")).alias("win_rate"))
    out = open_disputes.join(rate, by, "left")
    potential = F.col("underpayment_amount").cast("double") * F.coalesce("win_rate", F.lit(0.0))
    return out.withColumn("potential", potential).withColumn("route", F.when(F.col("potential") >= least, "pursue").otherwise("review"))


def tiered_alerts(deadlines: DataFrame, as_of: str | None = None) -> DataFrame:
    """Z3: alerts at ten and three days left and when missed, each with its audience."""
    left = F.datediff(F.col("due_date"), as_date(as_of))
    tier = F.when(left < 0, "missed").when(left <= 3, "urgent").when(left <= 10, "warning")
    who = F.when(left < 0, "director").when(left <= 3, "supervisor").when(left <= 10, "analyst")
    return deadlines.where("status = 'pending'").withColumns({"days_remaining": left, "tier": tier, "audience": who}).where("tier is not null")


def add_business_days(start: Column, days: int) -> Column:
    """The day that is ``days`` working days (Monday to Friday) after ``start``."""
    ahead = F.sequence(F.date_add(start, 1), F.date_add(start, 7 * (days // 5 + 2)))
    return F.get(F.filter(ahead, lambda d: F.weekday(d) < 5), F.lit(days - 1))


def recovery_cube(lines: DataFrame, cr: DataFrame) -> DataFrame:
    """Line amounts by year, payer, code and region, with the subtotals of every combination of them.

    ``grouping`` tells which are summed over (bits, year first). Lines are summed up at the finest grain
    first, so the sixteen groupings multiply few rows.
    """
    side = cr.select("claim_id", "payer_id", F.year("date_of_service").alias("service_year"))
    by = ["service_year", "payer_id", "cpt_code", "geo_region"]
    fine = lines.join(side, "claim_id").groupBy(*by).agg(F.count("*").alias("k"), F.sum("billed_amount").alias("v"))
    return fine.cube(*by).agg(F.grouping_id().alias("grouping"), F.sum("k").alias("line_count"), F.sum("v").cast("double").alias("total_billed"))


def award_spread(disputes: DataFrame, cases: DataFrame) -> DataFrame:
    """Award against qualifying payment amount by payer."""
    rows = disputes.join(cases.where("award_amount is not null").select("case_id", money("award_amount").alias("award")), "case_id")
    return rows.groupBy("payer_id").agg(F.count("*").alias("award_count"), mean(F.sum(F.col("award") - F.col("qpa_amount")), F.count("*")).alias("avg_spread"), percent(F.sum("award"), F.sum("qpa_amount")).alias("award_to_qpa_pct"))


def adjustment_mix(remits: DataFrame, categories: DataFrame) -> DataFrame:
    """Amounts of adjustments by payer and category; the reason's category, else the group's."""
    rows = remits.select("payer_id", F.explode("adjustments").alias("a")).select("payer_id", "a.*")
    side = categories.groupBy("code").agg(F.min("category").alias("category"))
    by_reason = side.select(F.col("code").alias("reason_code"), F.col("category").alias("_r"))
    by_group = side.select(F.col("code").alias("group_code"), F.col("category").alias("_g"))
    kinds = ["denial", "contractual", "patient_resp", "informational"]
    out = rows.join(by_reason, "reason_code", "left").join(by_group, "group_code", "left").withColumn("category", F.coalesce("_r", "_g", F.lit("informational")))
    return out.groupBy("payer_id").pivot("category", kinds).agg(F.sum("amount")).fillna(0)


def duplicate_patients(patients: DataFrame) -> DataFrame:
    """Patients that share record number, birth date and last name."""
    key = [F.upper(F.trim("insurance_id")).alias("record_no"), "dob", F.upper(F.trim("last_name")).alias("family")]
    return patients.groupBy(*key).agg(F.count("*").alias("n"), F.min("patient_id").alias("first_id"), F.max("patient_id").alias("last_id")).where("n > 1 and record_no is not null")


def reconcile_roster(stored: DataFrame, roster: DataFrame, keys: list[str], state: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, new state, stored table after the upsert) of a nightly roster."""
    events, fresh = snapshot_diff(roster, keys, state, "roster")
    return events, fresh, upsert(stored, roster, keys)


def localities(claims: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Locality by the first three digits of the ZIP code."""
    return claims.withColumn("zip3", F.substring("zip", 1, 3)).join(crosswalk.select("zip3", "locality"), "zip3", "left")


def rate_mismatch(published: DataFrame, contract: DataFrame, keys: list[str]) -> DataFrame:
    """Rates that differ, or stand on one side only."""
    a = published.select(*keys, F.col("rate").alias("published_rate"))
    b = contract.select(*keys, F.col("rate").alias("contract_rate"))
    state = F.when(F.col("published_rate").isNull(), "contract_only").when(F.col("contract_rate").isNull(), "published_only").otherwise("differs")
    return a.join(b, keys, "full_outer").where(~F.col("published_rate").eqNullSafe(F.col("contract_rate"))).withColumn("state", state)


def percentile_tiers(fees: DataFrame, tiers: list[str], default: str) -> DataFrame:
    """Rate types of a code as columns, and the default one."""
    return fees.groupBy("cpt_code", "geo_region").pivot("rate_type", tiers).agg(F.max("rate")).withColumn("default_rate", F.col(f"`{default}`"))


def median_rates(history: DataFrame) -> DataFrame:
    """Median contracted rate by code and region, by selection over value bits."""
    counts = history.groupBy("cpt_code", "geo_region").agg(F.count("*").alias("contract_count"))
    return counts.join(exact_median(history.withColumn("rate", money("rate")), ["cpt_code", "geo_region"], "rate"), ["cpt_code", "geo_region"]).select("cpt_code", "geo_region", "contract_count", F.col("median").alias("qpa"))
