"""Exact medians by distributed selection: no group's values ever meet in one buffer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

#: Bits of the value that one pass settles, and passes over the 64 bits.
DIGIT, PASSES = 16, 4


def exact_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys``, n (values that aren't null) and median (double) of each group of a decimal column of up to 18 digits.

    The middle one or two values are found by their bits from the highest on: a pass counts, among the values that
    share the bits settled so far, those of each next DIGIT bits, and takes the digit where the wanted rank
    lies. Counts combine in the tasks; a group has 2**DIGIT counts at most, however many values. A group without a value has
    n 0 and a null median; null keys are a group like others.
    """
    kind = df.schema[value].dataType
    if not isinstance(kind, DecimalType) or kind.precision > 18:
        raise TypeError(f"{value} must be a decimal of up to 18 digits")
    scale = kind.scale
    group = F.struct(*[F.col(k) for k in keys]).alias("g")
    whole = (F.col(value) * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast("long").alias("x")
    rows = df.select(group, whole)
    sizes = rows.groupBy("g").agg(F.count("x").alias("n"))
    ranks = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))
    at = sizes.where("n > 0").select("g", F.explode(ranks).alias("rank")).select("g", F.col("rank").alias("wanted"), "rank", F.lit(None).cast("long").alias("high"))
    for p in range(1, PASSES + 1):
        left = 64 - DIGIT * p
        some = rows.where("x is not null").select("g", F.shiftright("x", left).alias("d"), (F.shiftright("x", left + DIGIT) if p > 1 else F.lit(None).cast("long")).alias("h"))
        near = some.alias("s").join(at.alias("t"), F.col("s.g").eqNullSafe(F.col("t.g")) & F.col("s.h").eqNullSafe(F.col("t.high")))
        counts = near.select("t.g", "wanted", "rank", "d").groupBy("g", "wanted", "rank", "d").agg(F.count("*").alias("c"))
        upto = F.sum("c").over(Window.partitionBy("g", "wanted").orderBy("d"))
        found = counts.withColumn("upto", upto).where("upto > rank and upto - c <= rank")
        at = found.select("g", "wanted", (F.col("rank") - (F.col("upto") - F.col("c"))).alias("rank"), F.col("d").alias("high"))
    half = lambda f: (f("high").cast("decimal(20,0)") / F.lit(10**scale)).cast("double") * 0.5
    middle = at.groupBy("g").agg((half(F.min) + half(F.max)).alias("median"))
    out = sizes.alias("s").join(middle.alias("m"), F.col("s.g").eqNullSafe(F.col("m.g")), "left")
    return out.select("s.g.*", "n", "median")
