"""Registered queries of ingest, validation, matching, routing and streams over the mapped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import streaming
from .operators import ingest, merge, sinks
from .operators.table import VersionedTable
from .plans import design, reports, silver
from .plans.incremental import CLAIM, REMITTANCE, GoldViews
from .queries import CTE, fees, query
from .session import scratch
from .sources.mapped import AS_OF, Mapped
from .streaming import versions


@query("t1_patients", "SELECT c_custkey AS patient_id, c_name AS last_name, c_mktsegment AS insurance_id FROM customer")
def _patients(m: Mapped) -> DataFrame:
    rows = m.raw("customer").select(F.col("c_custkey").alias("patient_id"), F.lit("").alias("first_name"), F.col("c_name").alias("last_name"), *[F.lit(None).cast("string").alias(c) for c in ("dob", "gender", "city", "state", "zip")], F.col("c_mktsegment").alias("insurance_id"))
    return silver.patients(rows).select("patient_id", "last_name", "insurance_id")


@query("t2_providers", "SELECT npi, name, specialty, state FROM m_providers WHERE npi % 5 <> 0")
def _providers(m: Mapped) -> DataFrame:
    now = m.providers().withColumns({"facility_name": F.lit(""), "valid_from": F.lit("2020-01-01").cast("date"), "is_current": (F.col("npi") % 5 != 0).cast("int")})
    old = now.where("is_current = 1").withColumns({"valid_from": F.lit("2019-01-01").cast("date"), "name": F.lit("former")})
    return silver.providers(now.unionByName(old)).select("npi", "name", "specialty", "state")


@query(
    "v1_validate_claims",
    "SELECT claim_id, CAST(CASE WHEN total_billed IS NULL OR total_billed <= 100000 THEN 1 ELSE 0 END AS BIGINT) + CAST(CASE WHEN NOT EXISTS (SELECT 1 FROM m_lines l WHERE l.claim_id = c.claim_id) THEN 1 ELSE 0 END AS BIGINT) AS n_errors FROM m_claims c",
)
def _validate_claims(m: Mapped) -> DataFrame:
    lines = m.claim_lines().groupBy("claim_id").agg(F.collect_list(F.struct("cpt_code")).alias("lines"))
    rows = m.claims().join(lines, "claim_id", "left").withColumns({"total_billed": F.col("total_billed") - 100_000, "diagnosis_codes": F.array(F.lit("D")), "provider_npi": F.col("provider_npi").cast("string"), "payer_id": F.col("payer_id").cast("string")})
    return ingest.validate_claims(rows).select("claim_id", F.size("errors").alias("n_errors"))


@query("v2_validate_remittances", "SELECT CASE WHEN paid_amount < 20000 THEN 'Missing paid_amount' ELSE '' END AS detail, count(*) AS n FROM m_remits GROUP BY 1")
def _validate_remits(m: Mapped) -> DataFrame:
    rows = m.remittances().withColumns({"trace_number": F.col("trace_number").cast("string"), "payer_claim_id": F.col("claim_id").cast("string"), "paid_amount": F.when(F.col("paid_amount") >= 20_000, F.col("paid_amount")), "adjustments": F.array(F.lit("x"))})
    return ingest.validate_remittances(rows).groupBy(F.array_join("errors", "; ").alias("detail")).agg(F.count("*").alias("n"))


@query("v6_dead_letters", "SELECT 'fee_csv' AS source, 'fee_schedule' AS entity_type, 'validation_failure' AS error_category, 'Missing geo_region' AS error_detail, CAST(p_partkey AS VARCHAR) AS entity_id, p_brand AS payload_code, 'pending' AS status FROM part WHERE p_partkey % 9 = 0")
def _letters(m: Mapped) -> DataFrame:
    rows = m.raw("part").select(F.col("p_brand").alias("cpt_code"), F.when(F.col("p_partkey") % 9 != 0, F.col("p_type")).alias("geo_region"), F.col("p_retailprice").alias("rate"), F.lit("2024-01-01").alias("effective_date"), F.lit("medicare").alias("rate_type"), F.col("p_partkey").alias("id"))
    _, letters = ingest.split_valid(ingest.validate_fees(rows), "fee_csv", "fee_schedule", "id")
    return letters.withColumn("payload_code", F.get_json_object("payload", "$.cpt_code")).drop("payload")


_CODE = "CASE o_orderstatus WHEN 'F' THEN '7' WHEN 'P' THEN '8' ELSE '1' END"


@query("e1_claim_actions", f"SELECT o_orderkey AS claim_id, CASE WHEN o_orderkey % 2 = 1 THEN 'insert' WHEN {_CODE} = '7' THEN 'update' WHEN {_CODE} = '8' THEN 'void' ELSE 'skip' END AS action FROM orders")
def _actions(m: Mapped) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "F", "7").when(F.col("o_orderstatus") == "P", "8").otherwise("1")
    rows = m.raw("orders").select(F.col("o_orderkey").alias("claim_id"), code.alias("frequency_code"), F.col("o_orderdate").alias("arrival"))
    return ingest.claim_actions(rows, rows.where("claim_id % 2 = 0")).select("claim_id", "action")


@query(
    "e5_match_claims",
    "SELECT CASE o_orderkey % 3 WHEN 0 THEN 'C' WHEN 1 THEN '00c' ELSE 'A-' END || o_orderkey AS payer_claim_id, CASE WHEN matched_by IS NOT NULL THEN 'C' || o_orderkey END AS claim_id, matched_by FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'exact' WHEN o_orderkey % 3 = 1 THEN 'normalised' WHEN o_orderkey % 2 = 0 THEN 'alias' END AS matched_by FROM orders) t",
)
def _match(m: Mapped) -> DataFrame:
    claims = m.raw("orders").select(F.concat(F.lit("C"), F.col("o_orderkey")).alias("claim_id"), "o_orderkey")
    key = F.when(F.col("o_orderkey") % 3 == 0, F.col("claim_id")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("00"), F.lower("claim_id"))).otherwise(F.concat(F.lit("A-"), F.col("o_orderkey")))
    alias = claims.where("o_orderkey % 2 = 0").select(F.concat(F.lit("A-"), F.col("o_orderkey")).alias("payer_claim_id"), F.lit("P").alias("payer_id"), "claim_id")
    return ingest.match_claims(claims.select(key.alias("payer_claim_id"), F.lit("P").alias("payer_id")), claims.select("claim_id"), alias).select("payer_claim_id", "claim_id", "matched_by")


@query("e7_backfill_dedup", "SELECT claim_id, CASE WHEN claim_id % 4 = 0 THEN 'new' WHEN claim_id % 4 = 1 THEN 'conflict' ELSE 'duplicate' END AS outcome FROM m_claims")
def _backfill(m: Mapped) -> DataFrame:
    old = m.claims().where("claim_id % 4 <> 0")
    new = m.claims().withColumn("total_billed", F.when(F.col("claim_id") % 4 == 1, F.col("total_billed") + 1).otherwise(F.col("total_billed")).cast("decimal(18,2)"))
    return ingest.backfill_dedup(new.select("claim_id", "date_of_service", "provider_npi", "total_billed"), old).select("claim_id", "outcome")


@query("e9_crosswalk", "SELECT CASE WHEN cpt_code = 'Brand#1' THEN 'STD-1' ELSE cpt_code END AS cpt_code, count(*) AS n FROM m_lines l WHERE EXISTS (SELECT 1 FROM m_claims c WHERE c.claim_id = l.claim_id) GROUP BY 1")
def _crosswalk(m: Mapped) -> DataFrame:
    lines = m.claim_lines().groupBy("claim_id").agg(F.collect_list(F.struct("cpt_code")).alias("lines"))
    claims = m.claims().select("claim_id", F.col("payer_id").cast("string").alias("payer_id")).join(lines, "claim_id")
    table = m.spark.createDataFrame([("Brand#1", "STD-1", "s"), ("Brand#1", "STD-2", "s")], "legacy_code string, standard_code string, source_system string")
    return ingest.apply_crosswalk(claims, table).select(F.explode("lines").alias("l")).groupBy(F.col("l.cpt_code").alias("cpt_code")).agg(F.count("*").alias("n"))


@query("k10_topics", "SELECT 'claims' AS topic, 'claim.received' AS event_type, 'claim' AS entity_type, CAST(o_orderkey AS VARCHAR) AS entity_id, CASE o_orderstatus WHEN 'F' THEN '7' WHEN 'P' THEN '8' ELSE '1' END AS code FROM orders WHERE o_orderkey % 2 = 1 OR o_orderstatus IN ('F', 'P')")
def _topics(m: Mapped) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "F", "7").when(F.col("o_orderstatus") == "P", "8").otherwise("1")
    rows = m.raw("orders").select(F.col("o_orderkey").alias("claim_id"), code.alias("frequency_code"), F.col("o_orderdate").alias("arrival"))
    return ingest.events(ingest.claim_actions(rows, rows.where("claim_id % 2 = 0")), "claim.received", "claim", "claim_id").withColumn("code", F.get_json_object("payload", "$.frequency_code")).drop("payload")


query("k1_payload", "SELECT 'U' AS _cdc_operation, 'claims' AS _source_table, CAST(claim_id AS VARCHAR) AS claim_id, status, CAST(CAST(total_billed AS VARCHAR) AS DOUBLE) AS total_billed FROM m_claims")(
    lambda m: sinks.as_payload(m.claims(), "claims", "U").select("_cdc_operation", "_source_table", F.get_json_object("payload", "$.claim_id").alias("claim_id"), F.get_json_object("payload", "$.status").alias("status"), F.get_json_object("payload", "$.total_billed").cast("double").alias("total_billed"))
)


@query("k1_bronze", "SELECT CAST(ts AS DATE) AS cdc_date, seq AS _cdc_seq, row_pk, op AS _cdc_operation FROM m_cdc UNION ALL SELECT CAST(ts AS DATE), seq, row_pk, op FROM m_cdc WHERE op = 'D'")
def _bronze(m: Mapped) -> DataFrame:
    path = scratch(m.spark, "bronze")
    sinks.append_bronze(m.cdc(), path)
    sinks.append_bronze(m.cdc().where("_cdc_operation = 'D'"), path)
    return m.spark.read.parquet(path).select("cdc_date", "_cdc_seq", "row_pk", "_cdc_operation")


query("c5_enrich_bronze", "SELECT seq AS _cdc_seq, op AS _cdc_operation, 'events' AS _source_table, TRUE AS loaded, CAST(NULL AS VARCHAR) AS _source_file FROM m_cdc UNION ALL SELECT claim_id, 'I', 'claims', TRUE, 'f-' || claim_id FROM m_claims")(
    lambda m: merge.enrich_bronze(m.cdc(), "events").select("_cdc_seq", "_cdc_operation", "_source_table", F.col("_bronze_loaded_ts").isNotNull().alias("loaded"), "_source_file").unionByName(merge.enrich_bronze(m.claims(), "claims", source_file=F.concat(F.lit("f-"), "claim_id")).select(F.col("claim_id").alias("_cdc_seq"), "_cdc_operation", "_source_table", F.col("_cdc_timestamp").isNotNull().alias("loaded"), "_source_file"))
)


@query(
    "z1_expected_vs_paid",
    "SELECT decision, count(*) AS n FROM (SELECT CASE WHEN h.rate IS NULL THEN 'no_rate' WHEN CAST(h.rate AS DOUBLE) - CAST(l.billed_amount AS DOUBLE) > CAST(h.rate AS DOUBLE) * 0.01 THEN 'dispute' ELSE 'close' END AS decision FROM (SELECT claim_id, line_number, min(cpt_code) AS cpt_code, min(geo_region) AS geo_region, min(billed_amount) AS billed_amount FROM m_lines GROUP BY 1, 2) l JOIN m_claims c ON c.claim_id = l.claim_id LEFT JOIN h_fees h ON h.payer_id = 'MEDICARE' AND h.cpt_code = l.cpt_code AND h.geo_region = l.geo_region AND c.date_of_service BETWEEN h.valid_from AND h.valid_to) t GROUP BY decision",
)
def _expected(m: Mapped) -> DataFrame:
    return _decisions(m).groupBy("decision").agg(F.count("*").alias("n"))


@query(
    "z1_decisions",
    "SELECT l.claim_id, l.line_number, CAST(h.rate AS DOUBLE) AS rate, CASE WHEN h.rate IS NULL THEN 'no_rate' WHEN CAST(h.rate AS DOUBLE) - CAST(l.billed_amount AS DOUBLE) > CAST(h.rate AS DOUBLE) * 0.01 THEN 'dispute' ELSE 'close' END AS decision FROM (SELECT claim_id, line_number, min(cpt_code) AS cpt_code, min(geo_region) AS geo_region, min(billed_amount) AS billed_amount FROM m_lines GROUP BY 1, 2) l JOIN m_claims c ON c.claim_id = l.claim_id LEFT JOIN h_fees h ON h.payer_id = 'MEDICARE' AND h.cpt_code = l.cpt_code AND h.geo_region = l.geo_region AND c.date_of_service BETWEEN h.valid_from AND h.valid_to",
)
def _decision_rows(m: Mapped) -> DataFrame:
    return _decisions(m).select("claim_id", "line_number", "rate", "decision")


def _decisions(m: Mapped) -> DataFrame:
    lines = m.claim_lines().groupBy("claim_id", "line_number").agg(F.min("cpt_code").alias("cpt_code"), F.min("geo_region").alias("geo_region"), F.min("billed_amount").alias("billed_amount"))
    rows = lines.join(m.claims().select("claim_id", "date_of_service"), "claim_id")
    return design.expected_vs_paid(rows, fees(m).where("payer_id = 'MEDICARE'"), ["cpt_code", "geo_region"], "billed_amount")


query("z12_rate_mismatch", "SELECT id, published_rate, contract_rate, state FROM (SELECT coalesce(a.id, b.id) AS id, a.r AS published_rate, b.r AS contract_rate, CASE WHEN a.id IS NULL THEN 'contract_only' WHEN b.id IS NULL THEN 'published_only' ELSE 'differs' END AS state FROM (SELECT p_partkey AS id, p_retailprice AS r FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT p_partkey AS id, p_retailprice + (p_partkey % 2) AS r FROM part WHERE p_partkey % 5 <> 0) b ON a.id = b.id WHERE a.r IS DISTINCT FROM b.r) t")(
    lambda m: (lambda p: design.rate_mismatch(p.where("id % 3 <> 0"), p.where("id % 5 <> 0").withColumn("rate", F.col("rate") + F.col("id") % 2), ["id"]))(m.raw("part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("rate")))
)
query("z15_percentile_tiers", "SELECT cpt_code, geo_region, CAST(max(CASE WHEN payer_id = 'MEDICARE' THEN rate END) AS DOUBLE) AS MEDICARE, CAST(max(CASE WHEN payer_id = 'FAIR_HEALTH' THEN rate END) AS DOUBLE) AS FAIR_HEALTH, CAST(max(CASE WHEN payer_id = 'MEDICARE' THEN rate END) AS DOUBLE) AS default_rate FROM m_fees GROUP BY cpt_code, geo_region")(
    lambda m: design.percentile_tiers(m.fee_versions().withColumn("rate_type", F.col("payer_id")), ["MEDICARE", "FAIR_HEALTH"], "MEDICARE")
)
query("z10_localities", "SELECT c.claim_id, substr(CAST(700 + payer_id AS VARCHAR), 1, 3) AS zip3, CASE WHEN payer_id % 2 = 0 THEN 'LOC-' || payer_id END AS locality FROM m_claims c")(
    lambda m: design.localities(m.claims().withColumn("zip", F.concat((F.col("payer_id") + 700).cast("string"), F.lit("12"))), m.payers().where("payer_id % 2 = 0").select((F.col("payer_id") + 700).cast("string").alias("zip3"), F.concat(F.lit("LOC-"), "payer_id").alias("locality"))).select("claim_id", "zip3", "locality")
)
query("r9_dead_letters", "SELECT entity_id, seen_at FROM (SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, CAST(o_orderdate AS DATE) AS seen_at, CASE WHEN o_orderkey % 3 = 0 THEN 'pending' ELSE 'resolved' END AS status FROM orders WHERE o_orderkey % 2 = 0) t WHERE status = 'pending' ORDER BY seen_at DESC, entity_id LIMIT 20")(
    lambda m: (lambda d: reports.latest(ingest.pending(ingest.resolve_letters(d, d.where("cast(entity_id as long) % 3 <> 0"), "tester")), "seen_at", "entity_id").select("entity_id", "seen_at"))(
        m.raw("orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("entity_id"), F.col("o_orderdate").cast("date").alias("seen_at"), F.lit("pending").alias("status"))
    )
)
query("r9_audit", "SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS seen_at FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, CAST(o_orderkey AS VARCHAR) LIMIT 20")(
    lambda m: reports.latest(ingest.audit(m.raw("orders"), "claim", "o_orderkey", "insert", at=F.col("o_orderdate").cast("date").cast("timestamp")), "timestamp", "entity_id").select("entity_id", F.col("timestamp").cast("timestamp_ntz").alias("seen_at"))
)


# ---- streams over the events table, run over all that is there


def _stream(m: Mapped) -> DataFrame:
    schema = m.raw("events").schema
    return m.spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{m.sf_dir}/events*.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _ran(m: Mapped, stream: DataFrame, mode: str = "append") -> DataFrame:
    """All rows of a finished run, from a folder that all executors share."""
    base = scratch(m.spark, "stream")
    if mode == "append":
        streaming.run_to_table(stream, f"{base}/out", f"{base}/checkpoint")
    else:
        stream.writeStream.foreachBatch(lambda b, _: sinks.overwrite(b, f"{base}/out")).outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return m.spark.read.parquet(f"{base}/out")


query("st3_stream_dedup", "SELECT count(DISTINCT event_id) AS n FROM events")(lambda m: _ran(m, streaming.deduplicated(_stream(m).select("event_id", "ts"), ["event_id"], "ts", "3650 days")).agg(F.count("*").alias("n")))
query("st4_stream_windows", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")(
    lambda m: _ran(m, streaming.rolling_counts(_stream(m), "ts", "event_type", "1 day", late="3650 days"), "complete").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")
)
query("st4_stream_shares", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS hits, round(count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*), 2) AS share_pct FROM events GROUP BY 1")(
    lambda m: _ran(m, streaming.rolling_shares(_stream(m), "ts", F.col("event_type") == "error", "1 day", late="3650 days"), "complete").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", "hits", "share_pct")
)


@query("st1_bronze", "SELECT event_id, user_id, event_type, 'I' AS _cdc_operation, 'events' AS _source_table FROM events")
def _stream_bronze(m: Mapped) -> DataFrame:
    """Two runs over the same files: the second finds nothing new."""
    base = scratch(m.spark, "bronze")
    m.raw("events").write.parquet(f"{base}/in")
    for _ in range(2):
        streaming.bronze(m.spark, f"{base}/in", m.raw("events").schema, "events", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return VersionedTable(m.spark, f"{base}/out").read().select("event_id", "user_id", "event_type", "_cdc_operation", "_source_table")


def _forget_last_batch(m: Mapped, checkpoint: str) -> None:
    """Take a stream's last batch out of its log of finished ones, as a crash after the write leaves it."""
    fs_path = m.spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = fs_path.getFileSystem(m.spark._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(fs_path) if s.getPath().getName().isdigit()]
    fs.delete(max(names, key=lambda p: int(p.getName())), False)


@query("st1_replayed", "SELECT event_id, user_id, event_type, props, 'I' AS _cdc_operation, 'events' AS _source_table FROM events")
def _replayed_bronze(m: Mapped) -> DataFrame:
    """Two batches, the second of which is run twice."""
    base = scratch(m.spark, "bronze")
    rows = m.raw("events")
    run = lambda: streaming.bronze(m.spark, f"{base}/in", rows.schema, "events", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    for part in ("event_id % 2 = 0", "event_id % 2 <> 0"):
        rows.where(part).write.mode("append").parquet(f"{base}/in")
        run()
    _forget_last_batch(m, f"{base}/checkpoint")
    run()
    return VersionedTable(m.spark, f"{base}/out").read().select("event_id", "user_id", "event_type", "props", "_cdc_operation", "_source_table")


def _stream_claims(m: Mapped) -> str:
    from .source_queries import _incoming, _stored

    base = scratch(m.spark, "claims")
    claims, lines = _stored(m)
    VersionedTable(m.spark, f"{base}/claims").upsert(claims, ["claim_id"])
    VersionedTable(m.spark, f"{base}/lines").upsert(lines, ["claim_id"])
    rows = _incoming(m)
    for late in (False, True):  # two batches: the files of the second come when the first is done
        rows.where("arrival >= 3" if late else "arrival < 3").write.mode("append").parquet(f"{base}/in")
        streaming.ingest_claims(streaming.source(m.spark, f"{base}/in", rows.schema), f"{base}/claims", f"{base}/lines", f"{base}/checkpoint").awaitTermination()
    return base


def _register_claims() -> None:
    from .source_queries import _AFTER, _AFTER_LINES, _UNTOUCHED

    query("st2_stream_claims", _AFTER + _UNTOUCHED)(lambda m: VersionedTable(m.spark, f"{_stream_claims(m)}/claims").read().select("claim_id", "total_billed", "status"))
    query("st2_stream_lines", _AFTER_LINES)(lambda m: VersionedTable(m.spark, f"{_stream_claims(m)}/lines").read().groupBy("claim_id").agg(F.count("*").alias("n_lines")))


_register_claims()


def _claim_versions(m: Mapped) -> DataFrame:
    """Stored claims, then records in the wrong order over two runs: replacements and last voids before originals."""
    from .source_queries import _incoming, _stored

    base = scratch(m.spark, "claims")
    claims, lines = _stored(m)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("line_number", "cpt_code"))), lambda x: F.struct(x["cpt_code"].alias("cpt_code")))
    rows = _incoming(m).withColumn("arrival", F.timestamp_add("day", F.col("arrival"), F.lit("2024-01-01").cast("timestamp"))).withColumn("status", F.lit(None).cast("string"))
    stored = claims.join(lines.groupBy("claim_id").agg(in_order.alias("lines")), "claim_id", "left").withColumns({"frequency_code": F.lit(None).cast("string"), "arrival": F.lit(None).cast("timestamp")})
    late = F.col("arrival") >= "2024-01-04"
    for batch in (stored.select(rows.columns), rows.where(late), rows.where(~late)):
        batch.write.mode("append").parquet(f"{base}/in")
        streaming.run_to_table(versions.claim_changes(streaming.source(m.spark, f"{base}/in", rows.schema)), f"{base}/out", f"{base}/checkpoint")
    return versions.current(m.spark.read.parquet(f"{base}/out"), ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("total_billed", "lines")))


def _register_versions() -> None:
    from .source_queries import _AFTER, _AFTER_LINES, _UNTOUCHED

    query("st2_stateful_claims", _AFTER + _UNTOUCHED)(lambda m: _claim_versions(m).select("claim_id", "total_billed", "status"))
    query("st2_stateful_lines", _AFTER_LINES)(lambda m: _claim_versions(m).select("claim_id", F.explode("lines")).groupBy("claim_id").agg(F.count("*").alias("n_lines")))


_register_versions()


@query(
    "st5_claims_with_remittances",
    "SELECT c.claim_id, CAST(r.paid_amount AS DOUBLE) AS paid_amount, CAST(r.era_date AS TIMESTAMP) AS paid_at FROM m_claims c JOIN m_remits r ON r.claim_id = c.claim_id AND r.era_date BETWEEN c.date_of_service AND c.date_of_service + 45",
)
def _stream_join(m: Mapped) -> DataFrame:
    base = scratch(m.spark, "join")
    m.claims().select("claim_id", F.col("date_of_service").cast("timestamp").alias("filed_at")).write.parquet(f"{base}/claims")
    m.remittances().select("claim_id", F.col("era_date").cast("timestamp").alias("paid_at"), "paid_amount").write.parquet(f"{base}/remits")
    read = lambda name: streaming.source(m.spark, f"{base}/{name}", m.spark.read.parquet(f"{base}/{name}").schema)
    joined = streaming.claims_with_remittances(read("claims"), read("remits")).select("claim_id", "paid_amount", "paid_at")
    # Claims that are still waiting at the end of the stream come without one, and so may come those past their time.
    return _ran(m, joined).where("paid_at is not null").select("claim_id", "paid_amount", F.col("paid_at").cast("timestamp_ntz").alias("paid_at"))


@query("st6_fan_out", "SELECT event_type AS topic, event_id FROM events")
def _stream_topics(m: Mapped) -> DataFrame:
    base = scratch(m.spark, "topics")
    streaming.fan_out(_stream(m).select(F.col("event_type").alias("topic"), "event_id"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return VersionedTable(m.spark, f"{base}/out").read().select("topic", "event_id")


@query("st6_replayed", "SELECT event_type AS topic, event_id, user_id, props FROM events")
def _replayed_topics(m: Mapped) -> DataFrame:
    """One batch, run twice."""
    base = scratch(m.spark, "topics")
    run = lambda: streaming.fan_out(_stream(m).select(F.col("event_type").alias("topic"), "event_id", "user_id", "props"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    run()
    _forget_last_batch(m, f"{base}/checkpoint")
    run()
    return VersionedTable(m.spark, f"{base}/out").read().select("topic", "event_id", "user_id", "props")


# ---- gold by differences


def _events(rows: DataFrame, table: str, op: str, seq: int) -> DataFrame:
    return sinks.as_payload(rows, table, op, at=F.lit("2001-08-01").cast("timestamp")).withColumn("_cdc_seq", F.lit(seq).cast("long"))


def _numbered(m: Mapped) -> DataFrame:
    """Remittances with an id of their own inside their claim."""
    order = Window.partitionBy("claim_id").orderBy("trace_number", "era_date", "paid_amount", "allowed_amount", F.coalesce("denial_code", F.lit("~")))
    return m.remittances().withColumn("remit_id", F.col("claim_id") * 100 + F.row_number().over(order)).select([c.split()[0] for c in REMITTANCE.split(", ")])


def _written(rows: DataFrame) -> DataFrame:
    """The same rows, made once for all batches that have events of them."""
    path = scratch(rows.sparkSession, "rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _views(m: Mapped, batches: list[DataFrame]) -> GoldViews:
    """Each batch's events come as files once the batch before is done."""
    base = scratch(m.spark, "gold")
    views = GoldViews(m.spark, f"{base}/views", m.payers())
    for events in batches:
        events.write.mode("append").parquet(f"{base}/in")
        streaming.refresh_gold(streaming.source(m.spark, f"{base}/in", events.schema), views, f"{base}/checkpoint").awaitTermination()
    return views


def _claim_rows(m: Mapped) -> DataFrame:
    return m.claims().select([c.split()[0] for c in CLAIM.split(", ")])


@query("st7_refresh_gold", "SELECT payer_id, total_claims, total_billed FROM g1")
def _stream_gold(m: Mapped) -> DataFrame:
    events = _events(_claim_rows(m), "claims", "I", 0).unionByName(_events(_numbered(m), "remittances", "I", 0))
    return _views(m, [events]).recovery().select("payer_id", "total_claims", "total_billed")


def _three_batches(m: Mapped) -> GoldViews:
    """Inserts; inserts, updates and a changed payer; deletes, changed remittances and a claim twice in a batch."""
    claims, remits = _written(_claim_rows(m)), _written(_numbered(m))
    one = [_events(claims.where("claim_id % 5 <> 0"), "claims", "I", 0), _events(remits.where("claim_id % 3 <> 0"), "remittances", "I", 0)]
    moved = claims.where("claim_id % 4 = 0 and claim_id % 5 <> 0").withColumns({"total_billed": (F.col("total_billed") + 1).cast("decimal(18,2)"), "payer_id": (F.col("payer_id") + 1) % 25})
    two = [_events(claims.where("claim_id % 5 = 0"), "claims", "I", 1), _events(moved, "claims", "U", 2), _events(remits.where("claim_id % 3 = 0"), "remittances", "I", 1)]
    more = remits.where("remit_id % 6 = 0").withColumn("paid_amount", (F.col("paid_amount") + 2).cast("decimal(18,2)"))
    again = claims.where("claim_id % 7 = 0").withColumn("total_billed", F.lit(1).cast("decimal(18,2)"))
    three = [_events(again, "claims", "U", 3), _events(claims.where("claim_id % 7 = 0").select("claim_id"), "claims", "D", 4), _events(more, "remittances", "U", 3), _events(remits.where("remit_id % 11 = 0").select("claim_id", "remit_id"), "remittances", "D", 4)]
    join = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(join(parts[1:]))
    return _views(m, [join(x) for x in (one, two, three)])


def _rebuilt(body: str) -> str:
    """The SQL of a full build over the tables as the three batches leave them."""
    claims = f"SELECT claim_id, patient_id, provider_npi, CASE WHEN claim_id % 4 = 0 AND claim_id % 5 <> 0 THEN (payer_id + 1) % 25 ELSE payer_id END AS payer_id, date_of_service, CAST(total_billed + CASE WHEN claim_id % 4 = 0 AND claim_id % 5 <> 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS total_billed, status FROM ({CTE['m_claims']}) c WHERE claim_id % 7 <> 0"
    remits = f"SELECT claim_id, trace_number, era_date, CAST(paid_amount + CASE WHEN remit_id % 6 = 0 THEN 2 ELSE 0 END AS DECIMAL(18,2)) AS paid_amount, allowed_amount, denial_code FROM (SELECT *, claim_id * 100 + row_number() OVER (PARTITION BY claim_id ORDER BY trace_number, era_date, paid_amount, allowed_amount, coalesce(denial_code, '~')) AS remit_id FROM ({CTE['m_remits']}) r) r WHERE remit_id % 11 <> 0"
    names = ["m_payers", "r1", "cr", "g1", "g3a", "g3", "g5"]
    return f"WITH m_claims AS ({claims}), m_remits AS ({remits}), " + ", ".join(f"{n} AS ({CTE[n]})" for n in names) + " " + body


query("st7_incremental", _rebuilt("SELECT * FROM g1"), whole=True)(lambda m: _three_batches(m).recovery())
query("st7_incremental_scorecard", _rebuilt("SELECT payer_id, payer_name, total_claims, payment_rate_pct, denial_rate_pct, avg_underpayment, total_underpayment, risk_tier, payer_type FROM g3"), whole=True)(lambda m: _three_batches(m).scorecard())
query("st7_incremental_aging", _rebuilt("SELECT * FROM g5"), whole=True)(lambda m: _three_batches(m).aging(AS_OF))
