"""Data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orphans(edges: list[tuple[str, DataFrame, str, DataFrame, str]], optional: tuple[str, ...] = ()) -> DataFrame:
    """Q1: for each (name, child, key, parent, key) the children whose key has no parent.

    A null key has none; in the checks named in ``optional`` it needs none.
    """
    one = []
    for name, child, ck, parent, pk in edges:
        keys = child.select(F.col(ck).alias("_k"))
        keys = keys.where("_k is not null") if name in optional else keys
        lost = keys.join(parent.select(F.col(pk).alias("_k")).distinct(), "_k", "left_anti")
        one.append(lost.agg(F.count("*").alias("orphan_count")).select(F.lit(name).alias("check_name"), "orphan_count"))
    return reduce(DataFrame.unionByName, one)


def rules(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Q2: rows that break each rule, from one pass, failures first."""
    one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    out = one.unpivot([], list(checks), "rule_name", "violations")
    return out.withColumn("result", F.when(F.col("violations") > 0, "FAIL").otherwise("PASS")).orderBy(F.when(F.col("violations") > 0, 0).otherwise(1), "rule_name")


# What claims and cases must cover, and the number of each that must be exceeded.
LEAST = {"claim_months": 6, "claim_payers": 4, "claim_providers": 3, "case_outcomes": 5, "case_analysts": 2}


def coverage(claims: DataFrame, cases: DataFrame) -> DataFrame:
    """Q2: whether there are enough different months, payers and providers of claims, and outcomes and analysts of cases."""
    of_claims = {"claim_months": F.countDistinct(F.date_format("date_of_service", "yyyy-MM")), "claim_payers": F.countDistinct("payer_id"), "claim_providers": F.countDistinct("provider_npi")}
    of_cases = {"case_outcomes": F.count("outcome"), "case_analysts": F.countDistinct("assigned_analyst")}
    parts = [df.agg(*[c.alias(n) for n, c in checks.items()]).unpivot([], list(checks), "check_name", "n") for df, checks in ((claims, of_claims), (cases, of_cases))]
    least = F.element_at(F.create_map(*[F.lit(x) for pair in LEAST.items() for x in pair]), F.col("check_name"))
    return parts[0].unionByName(parts[1]).select("check_name", "n", least.alias("more_than"), (F.col("n") > least).alias("enough"))


def totals(cr: DataFrame, disputes: DataFrame, cases: DataFrame) -> DataFrame:
    """Q3: totals of the layers side by side, as rows."""
    sums = [
        cr.agg(F.sum("total_billed").cast("double").alias("v")).select(F.lit("claims_billed").alias("total_name"), "v"),
        cr.agg(F.sum("total_paid").cast("double").alias("v")).select(F.lit("claims_paid").alias("total_name"), "v"),
        disputes.agg(F.sum("underpayment_amount").cast("double").alias("v")).select(F.lit("disputes_underpayment").alias("total_name"), "v"),
        cases.agg(F.sum(F.col("award_amount")).cast("double").alias("v")).select(F.lit("cases_awarded").alias("total_name"), "v"),
    ]
    return reduce(DataFrame.unionByName, sums)


def consistency(recovery: DataFrame, summary: DataFrame, trends: DataFrame, aging: DataFrame) -> DataFrame:
    """Q4: gold tables that must agree: payers' sum and months' sum with the summary, shares with 100."""
    s = summary.where("metric_name = 'total_billed'").agg(F.max("metric_value").alias("expected"))
    payers = recovery.agg(F.sum("total_billed").alias("actual"))
    months = trends.agg(F.sum("total_billed").alias("actual"))
    share = aging.agg(F.sum("pct_of_total").alias("actual"))
    hundred = share.select(F.lit(100.0).alias("expected"), "actual", F.lit("aging_share").alias("check_name"))
    pair = lambda x, n: s.join(x).select("expected", "actual", F.lit(n).alias("check_name"))  # noqa: E731  one row each
    return pair(payers, "payer_sum").unionByName(pair(months, "month_sum")).unionByName(hundred).select("check_name", F.round("expected", 2).alias("expected"), F.round("actual", 2).alias("actual"), (F.abs(F.col("expected") - F.col("actual")) < 0.1).alias("agrees"))


def stale(gold: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """Q5: age of the newest ``_gold_ts`` in minutes and whether it is over the limit."""
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.max("_gold_ts"))) / 60
    return gold.agg(age.alias("age_minutes")).withColumn("is_stale", F.coalesce(F.col("age_minutes") > minutes, F.lit(True)))


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Q6: for each column rows, share of nulls and count of distinct values (a sketch's estimate, unless ``exact``)."""
    distinct = F.countDistinct if exact else F.approx_count_distinct
    aggs = [x for c in df.columns for x in (F.avg(F.col(c).isNull().cast("double")).alias(f"{c}\u0001null"), distinct(F.col(c)).alias(f"{c}\u0001distinct"))]
    one = df.agg(F.count("*").alias("n"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("row_count"), F.round(F.col(f"`{c}\u0001null`"), 4).alias("null_rate"), F.col(f"`{c}\u0001distinct`").alias("approx_distinct")) for c in df.columns]))
    return one.select(rows.alias("r")).select("r.*")


def malformed(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Q6: values of a column that don't have the given form."""
    return df.agg(F.count_if(~F.coalesce(F.col(column).cast("string"), F.lit("")).rlike(pattern)).alias("malformed"), F.count("*").alias("row_count"))


QUANTILES = [i / 20 for i in range(1, 20)]


def day_sketches(df: DataFrame, columns: list[str], day: Column, k: int = 200) -> DataFrame:
    """Of each numeric column and day the count and a quantile sketch, which later days' can be merged with.

    A sketch of k = 200 gives the rank of a value within 1.65 % of the rows with a confidence of 99 %.
    """
    tall = df.select(day.alias("day"), F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])).alias("v")).select("day", "v.*")
    return tall.groupBy("column_name", "day").agg(F.count("x").alias("n"), F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, *by: str) -> DataFrame:
    """Q6: quantiles of each column over all days, or ``by`` further columns of the stored sketches."""
    one = sketches.where("n > 0").groupBy("column_name", *by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return one.select("column_name", *by, "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"q{round(q * 100):02d}") for q in QUANTILES])


def distribution_drift(sketches: DataFrame, limit: float = 0.1) -> DataFrame:
    """For each column and day the largest gap in rank between its quantiles and those of the day before that has any.

    Each quantile of the day is placed among those of the day before; ``drifts`` if one lies further off than
    ``limit`` of the rows (steps of 5 %). The first day has nothing before it (null).
    """
    before = Window.partitionBy("column_name").orderBy("day")  # a row a column and day
    pairs = sketches.where("n > 0").withColumn("old", F.lag("sketch").over(before))
    pairs = pairs.select("column_name", "day", "n", *[F.when(F.col(c).isNotNull(), F.array(*[F.kll_sketch_get_quantile_double(c, F.lit(q)) for q in QUANTILES])).alias(c) for c in ("sketch", "old")])
    among = lambda c, x: (F.size(F.filter(c, lambda y: y < x)) + F.size(F.filter(c, lambda y: y <= x))) / (2 * len(QUANTILES))
    gap = F.when(F.col("old").isNotNull(), F.array_max(F.transform("sketch", lambda x: F.abs(among("old", x) - among("sketch", x)))))
    return pairs.select("column_name", "day", "n", gap.alias("gap")).withColumn("drifts", F.coalesce(F.col("gap") > limit, F.lit(False)))


def frequent_values(df: DataFrame, columns: list[str], day: Column, share: float = 0.05) -> DataFrame:
    """Q6: values (as text) that at least ``share`` of a day's rows of a column have, with their exact counts.

    The first pass counts hashes of values in 10 / share buckets a day, which combine in the tasks; a value with the
    share lies in a bucket that has it. The second counts the values of such buckets alone, exactly.
    """
    buckets = int(10 / share)
    rows = df.select(day.alias("day"), F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("v")).select("day", "v.*")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    each = rows.groupBy("column_name", "day", "bucket").agg(F.count("*").alias("c"))
    n = each.groupBy("column_name", "day").agg(F.sum("c").alias("n"))
    heavy = each.join(n, ["column_name", "day"]).where(F.col("c") >= share * F.col("n")).select("column_name", "day", "bucket", "n")
    counts = rows.join(heavy, ["column_name", "day", "bucket"]).groupBy("column_name", "day", "value").agg(F.count("*").alias("value_count"), F.first("n").alias("n"))
    return counts.where(F.col("value_count") >= share * F.col("n")).select("column_name", "day", "value", "value_count", "n")
