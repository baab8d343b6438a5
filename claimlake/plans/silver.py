"""Silver: conformed tables out of resolved operational ones. Each function is one plan, empty-safe."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import denied, money

RESOLVED = ("met", "missed")
AT_RISK_DAYS = 5


def as_date(as_of: str | None) -> Column:
    return F.lit(as_of).cast("date") if as_of else F.current_date()


def patients(df: DataFrame) -> DataFrame:
    """T1."""
    return df.select("patient_id", "first_name", "last_name", "dob", "gender", "city", "state", "zip", "insurance_id")


def providers(df: DataFrame) -> DataFrame:
    """The current version of each provider; of several current ones the latest, then the first by its values."""
    shown = ["name", "specialty", "facility_name", "state"]
    latest = Window.partitionBy("npi").orderBy(F.col("valid_from").desc_nulls_last(), *shown)
    return df.where("coalesce(is_current, 1) = 1").withColumn("_n", F.row_number().over(latest)).where("_n = 1").select("npi", *shown)


def claims(df: DataFrame, lines: DataFrame) -> DataFrame:
    """Claims with line count, sorted distinct codes (empty without lines) and units."""
    per_claim = lines.groupBy("claim_id").agg(F.count("*").alias("line_count"), F.array_sort(F.collect_set("cpt_code")).alias("cpt_codes"), F.sum(F.coalesce("units", F.lit(1))).alias("total_units"))
    none = F.array().cast("array<string>")
    return df.join(per_claim, "claim_id", "left").withColumns({"line_count": F.coalesce("line_count", F.lit(0)), "cpt_codes": F.coalesce("cpt_codes", none), "total_units": F.coalesce("total_units", F.lit(0))})


def remittances(df: DataFrame, payers: DataFrame, claims_: DataFrame) -> DataFrame:
    """T4: remittances with payer (their own, else the claim's) and its name."""
    own = df if "payer_id" in df.columns else df.withColumn("payer_id", F.lit(None).cast(dict(claims_.dtypes)["payer_id"]))
    of_claim = claims_.select("claim_id", F.col("payer_id").alias("claim_payer"))
    names = payers.select("payer_id", F.col("name").alias("payer_name"))
    return own.join(of_claim, "claim_id", "left").withColumn("payer_id", F.coalesce("payer_id", "claim_payer")).drop("claim_payer").join(names, "payer_id", "left")


def claim_remittance(claims_: DataFrame, remits: DataFrame, payers: DataFrame) -> DataFrame:
    """T5: one row a claim with its remittances summed up beforehand."""
    per_claim = remits.groupBy("claim_id").agg(
        F.sum("paid_amount").alias("total_paid"), F.sum("allowed_amount").alias("total_allowed"), F.count("*").alias("remittance_count"), F.max(denied().cast("int")).alias("has_denial")
    )
    zero = F.lit(0).cast("decimal(18,2)")
    return (
        claims_.join(per_claim, "claim_id", "left")
        .join(payers.select("payer_id", F.col("name").alias("payer_name")), "payer_id", "left")
        .select(
            "claim_id",
            "payer_id",
            "payer_name",
            "provider_npi",
            "date_of_service",
            "status",
            "total_billed",
            F.coalesce("total_paid", zero).alias("total_paid"),
            F.coalesce("total_allowed", zero).alias("total_allowed"),
            (F.col("total_billed") - F.coalesce("total_paid", zero)).alias("underpayment"),
            F.coalesce("remittance_count", F.lit(0)).alias("remittance_count"),
            F.coalesce("has_denial", F.lit(0)).alias("has_denial"),
        )
    )


def fee_schedule(df: DataFrame) -> DataFrame:
    """All versions with defaults."""
    return df.withColumns({"modifier": F.coalesce("modifier", F.lit("")), "is_current": F.coalesce("is_current", F.lit(1))})


def disputes(df: DataFrame, claims_: DataFrame, payers: DataFrame) -> DataFrame:
    """Disputes with payer, provider, date of service and codes of their claim."""
    side = claims_.select("claim_id", "payer_id", "provider_npi", "date_of_service", *(["cpt_codes"] if "cpt_codes" in claims_.columns else []))
    return df.join(side, "claim_id", "left").join(payers.select("payer_id", F.col("name").alias("payer_name")), "payer_id", "left")


def cases(df: DataFrame, disputes_: DataFrame, as_of: str | None = None) -> DataFrame:
    """Cases with their disputes summed up and their age in whole days."""
    per_case = disputes_.groupBy("case_id").agg(F.count("*").alias("dispute_count"), F.sum("billed_amount").alias("total_billed"), F.sum("underpayment_amount").alias("total_underpayment"))
    zero = F.lit(0).cast("decimal(28,2)")
    return df.join(per_case, "case_id", "left").withColumns(
        {
            "dispute_count": F.coalesce("dispute_count", F.lit(0)),
            "total_billed": F.coalesce("total_billed", zero),
            "total_underpayment": F.coalesce("total_underpayment", zero),
            "age_days": F.coalesce(F.datediff(as_date(as_of), F.col("created_date")), F.lit(0)),
        }
    )


def deadlines(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Days remaining (null once resolved) and whether the deadline is at risk, overdue ones included."""
    left = F.when(~F.col("status").isin(*RESOLVED), F.datediff(F.col("due_date"), as_date(as_of)))
    return df.withColumn("days_remaining", left).withColumn("is_at_risk", F.coalesce((left <= AT_RISK_DAYS).cast("int"), F.lit(0)))


def refresh(tables: dict[str, DataFrame], as_of: str | None = None, write: Callable[[str, DataFrame], object] | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """All silver tables that can be built and, with ``write`` (name, frame), run; and why the others could not."""
    out: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    builders: dict[str, Callable[[], DataFrame]] = {
        "silver_patients": lambda: patients(tables["patients"]),
        "silver_providers": lambda: providers(tables["providers"]),
        "silver_claims": lambda: claims(tables["claims"], tables["claim_lines"]),
        "silver_remittances": lambda: remittances(tables["remittances"], tables["payers"], tables["claims"]),
        "silver_claim_remittance": lambda: claim_remittance(tables["claims"], tables["remittances"], tables["payers"]),
        "silver_fee_schedule": lambda: fee_schedule(tables["fee_schedule"]),
        "silver_disputes": lambda: disputes(tables["disputes"], out["silver_claims"], tables["payers"]),
        "silver_cases": lambda: cases(tables["cases"], tables["disputes"], as_of),
        "silver_deadlines": lambda: deadlines(tables["deadlines"], as_of),
    }
    for name, build in builders.items():
        try:
            df = build()
            if write is not None:  # plans mostly fail at their action
                write(name, df)
            out[name] = df
        except Exception as error:  # one table's trouble must not stop the others
            failed[name] = f"{type(error).__name__}: {error}"
    return out, failed


__all__ = ["cases", "claim_remittance", "claims", "deadlines", "disputes", "fee_schedule", "money", "patients", "providers", "refresh", "remittances"]
