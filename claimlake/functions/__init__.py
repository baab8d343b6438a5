"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def percent(part: Column, of: Column, digits: int = 2) -> Column:
    """part / of in percent, rounded; 0 where ``of`` is 0 or null."""
    whole = of.cast("double")
    return F.when(whole > 0, F.round(F.coalesce(part.cast("double"), F.lit(0.0)) * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def mean(total: Column, n: Column, digits: int = 2) -> Column:
    """total / n, rounded once, for a decimal sum: exact whatever the order of the rows; null without rows."""
    return F.round(total.cast("decimal(28,6)") / F.nullif(n, F.lit(0)).cast("decimal(12,0)"), digits).cast("double")


def share(amount: Column, n: Column) -> Column:
    """An n-th of a decimal amount, to a millionth, so that sums of shares are exact."""
    return F.round(money(amount) / n.cast("decimal(10,0)"), 6).cast("decimal(18,6)")


def blank(c: str) -> Column:
    """Null or without a character."""
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def parse_date(c: Column | str) -> Column:
    """A date from ISO, compact (YYYYMMDD) or US form; null if it is none of them."""
    text = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in ("yyyy-MM-dd", "yyyyMMdd", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss")])


def denied(code: str = "denial_code") -> Column:
    return F.col(code).isNotNull() & (F.col(code) != "")


def plain(df):
    """Decimals as double, short and plain integers as long: types that any reader shares."""
    kind = {"int": "long", "smallint": "long", "tinyint": "long"}
    return df.select([F.col(f"`{c}`").cast("double" if t.startswith("decimal") else kind.get(t, t)).alias(c) for c, t in df.dtypes])
