"""The domain's tables out of a star-schema data set (orders as claims, lines as claim lines and remittances)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money

AS_OF = "2001-08-01"
#: Claim lines that a task of a keyed shuffle takes, about, once there are more than the session's partitions: as
#: plain rows, and as lists inside the records of their claim, of which a task holds several forms at once.
ROWS_PER_TASK, LISTED_PER_TASK = 1_000_000, 250_000


class Mapped:
    """Lazily read domain tables of one folder; each is a plan, of which those of the files are made once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def tasks(self, name: str, per_task: int) -> int:
        """Partitions for a shuffle of a raw table's rows: those of the session, or more where the table is larger."""
        rows = self.raw(name).count()  # Parquet footers hold it
        return max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))

    def payers(self) -> DataFrame:
        kind = F.when(F.col("n_regionkey") % 3 == 0, "commercial").when(F.col("n_regionkey") % 3 == 1, "medicare").otherwise("medicaid")
        joined = self.raw("nation").join(F.broadcast(self.raw("region")), F.col("n_regionkey") == F.col("r_regionkey"))  # five rows
        return joined.select(F.col("n_nationkey").alias("payer_id"), F.col("n_name").alias("name"), kind.alias("type"), F.col("r_name").alias("state"))

    def providers(self) -> DataFrame:
        n = F.col("s_suppkey") % 4
        kind = F.when(n == 0, "Radiology").when(n == 1, "Cardiology").when(n == 2, "Anesthesiology").otherwise("Emergency")
        return self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("npi"), F.col("s_name").alias("name"), kind.alias("specialty"), F.col("n_name").alias("state"))

    def claim_lines(self) -> DataFrame:
        return self.raw("lineitem").join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("claim_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("p_brand").alias("cpt_code"),
            F.col("p_type").alias("geo_region"),
            F.col("l_quantity").cast("int").alias("units"),
            money("l_extendedprice").alias("billed_amount"),
        )

    def claims(self) -> DataFrame:
        npi = self.raw("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("provider_npi"))
        status = F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "filed").otherwise("underpaid")
        return (
            self.raw("orders")
            .join(self.raw("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(npi, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                F.col("o_orderkey").alias("claim_id"),
                F.col("o_custkey").alias("patient_id"),
                "provider_npi",
                F.col("c_nationkey").alias("payer_id"),
                F.col("o_orderdate").cast("date").alias("date_of_service"),
                money("o_totalprice").alias("total_billed"),
                status.alias("status"),
            )
        )

    def remittances(self) -> DataFrame:
        paid = money(money("l_extendedprice") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")))
        code = F.when(F.col("l_returnflag") == "R", "50").when(F.col("l_returnflag") == "A", "")
        return (
            self.raw("lineitem")
            .where("l_linestatus = 'F'")
            .select(
                F.col("l_orderkey").alias("claim_id"),
                F.col("l_linenumber").alias("trace_number"),
                F.col("l_shipdate").cast("date").alias("era_date"),
                paid.alias("paid_amount"),
                money("l_extendedprice").alias("allowed_amount"),
                code.alias("denial_code"),
            )
        )

    def fee_versions(self) -> DataFrame:
        """Versions of a rate for each payer, code and region: one for every part row.

        The first seven start yearly from 1995-01-01 on, each further one a day after the one before, so
        that 3,292 fit before 2010-01-01, from when on the merge query's new rates apply.
        """
        from pyspark.sql import Window

        payer = F.when(F.col("p_partkey") % 2 == 0, "MEDICARE").otherwise("FAIR_HEALTH")
        keyed = self.raw("part").select(payer.alias("payer_id"), F.col("p_brand").alias("cpt_code"), F.col("p_type").alias("geo_region"), money("p_retailprice").alias("rate"), F.col("p_partkey").alias("id"))
        version = F.row_number().over(Window.partitionBy("payer_id", "cpt_code", "geo_region").orderBy("id"))
        year = F.make_date(F.least("v", F.lit(7)) + 1994, F.lit(1), F.lit(1))
        return keyed.withColumn("v", version).withColumn("valid_from", F.date_add(year, F.greatest(F.col("v") - 7, F.lit(0))))

    def cdc(self) -> DataFrame:
        op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
        return self.raw("events").select(F.col("event_id").alias("_cdc_seq"), F.col("ts").alias("_cdc_timestamp"), F.col("user_id").alias("row_pk"), op.alias("_cdc_operation"), "value", "props")
