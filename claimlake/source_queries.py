"""Registered queries of readers, parsers and writers: feeds are rendered out of the given tables by Spark, written
to the shared folder, read back by the source and held against the table that they were made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import schemas
from .operators import ingest, merge, sinks
from .operators.table import VersionedTable
from .plans import design, quality, reports, silver, workflow
from .plans import gold as gold_plans
from .queries import ORACLES, Gold, fees, query
from .session import freed, scratch, setting
from .sources import files, mapped, parsers, workload
from .sources.mapped import AS_OF, Mapped

#: Records of a rendered file, about.
PER_FILE = 200
#: Rendered files of a folder, about.
PER_FOLDER = 100
#: Bytes of small splits that a task reads, about.
SPLIT_TASK_BYTES = 32 << 20


def _csv(m: Mapped, df: DataFrame, tag: str) -> str:
    path = scratch(m.spark, tag)
    df.write.option("header", True).csv(path)
    return path


def _folder(number: Column) -> Column:
    return F.floor(number / PER_FOLDER).alias("folder")


def _files(m: Mapped, records: DataFrame, tag: str, key: str, text: Column | str, join: str = "", head: str = "", tail: str = "", about: int | None = None, packed: bool = False) -> str:
    """Records (key, and what the text is made of) as files of about PER_FILE each, in order of key; ``about`` so many
    records, if that is known without counting them."""
    n = max(1, -(-(records.count() if about is None else about) // PER_FILE))
    path = scratch(m.spark, tag)
    placed = records.withColumn("file_no", F.pmod(F.xxhash64(key), F.lit(n))).withColumn("folder", _folder(F.col("file_no")))
    sinks.text_files(placed, path, [key, *(c for c in records.columns if c != key)], join, head, tail, text, packed)
    return path


# ---- S: readers

query(
    "s1_fee_csv",
    "SELECT p_brand AS cpt_code, p_type AS geo_region, CASE WHEN p_partkey % 9 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) END AS rate, 'medicare' AS rate_type, DATE '2024-01-01' AS effective_date, '' AS modifier FROM part",
)(lambda m: files.fee_csv(m.spark, _csv(m, m.raw("part").select(F.concat(F.lit(" "), "p_brand").alias("cpt_code"), F.lit(None).cast("string").alias("modifier"), F.col("p_type").alias("geo_region"), F.when(F.col("p_partkey") % 9 == 0, "n/a").otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string")).alias("rate"), F.lit("medicare ").alias("rate_type"), F.when(F.col("p_partkey") % 2 == 0, "2024-01-01").otherwise("20240101").alias("effective_date")), "fees")).drop("_corrupt_record"))


@query(
    "s2_nppes_csv",
    "SELECT CAST(npi AS VARCHAR) AS npi, name AS last_name, state, CASE WHEN npi % 4 = 0 THEN 'deactivated' ELSE 'active' END AS status, CASE WHEN npi % 4 = 0 THEN DATE '2020-05-06' END AS deactivation_date, substr('7500' || npi || '12345', 1, 5) AS zip FROM m_providers WHERE npi % 3 <> 0 AND (npi % 7 = 0 OR state IN ('NATION_1', 'NATION_2', 'NATION_3'))",
)
def _nppes(m: Mapped) -> DataFrame:
    off = F.col("npi") % 4 == 0
    raw = m.providers().select(
        F.col("state").alias("Provider Business Practice Location Address State Name"),
        F.concat(F.lit("7500"), "npi", F.lit("12345")).alias("Provider Business Practice Location Address Postal Code"),
        F.col("npi").alias("NPI"),
        F.when(F.col("npi") % 3 == 0, "2").otherwise("1").alias("Entity Type Code"),
        F.col("name").alias("Provider Last Name (Legal Name)"),
        F.lit("unread").alias("Another Column"),
        F.when(off, "DT").alias("NPI Deactivation Reason Code"),
        F.when(off, "05/06/2020").alias("NPI Deactivation Date"),
    )
    known = m.providers().where("npi % 7 = 0").select(F.col("npi").cast("string").alias("npi"))
    return files.nppes_csv(m.spark, _csv(m, raw, "nppes"), known, ["NATION_1", "NATION_2", "NATION_3"]).select("npi", "last_name", "state", "status", "deactivation_date", "zip")


@query(
    "s3_backfill_csv",
    "SELECT CAST(s.claim_id AS VARCHAR) AS claim_id, CAST(s.total_billed AS DOUBLE) AS total_billed, len(s.codes) AS n_lines, coalesce(array_to_string(s.codes, ','), '') AS codes, CASE WHEN len(s.codes) > 0 THEN (2 * CAST(s.total_billed * 100 AS HUGEINT) + len(s.codes)) // (2 * len(s.codes)) / 100.0 END AS each_billed, c.date_of_service FROM scl s JOIN m_claims c ON c.claim_id = s.claim_id",
)
def _backfill_csv(m: Mapped) -> DataFrame:
    rows = silver.claims(m.claims(), m.claim_lines()).select("claim_id", "patient_id", "provider_npi", "payer_id", "date_of_service", "total_billed", F.array_join("cpt_codes", " ; ").alias("cpt_codes"), F.lit("d1;d2").alias("diagnosis_codes"))
    back = files.backfill_csv(m.spark, _csv(m, rows, "backfill"))
    return back.select("claim_id", "total_billed", F.size("lines").alias("n_lines"), F.array_join(F.col("lines.cpt_code"), ",").alias("codes"), F.get("lines", F.lit(0))["billed_amount"].alias("each_billed"), "date_of_service")


@query("s4_crosswalk_csv", "SELECT p_brand AS legacy_code, 'STD-' || min(p_partkey) AS standard_code, p_type AS source_system FROM part WHERE p_brand <> 'Brand#1' GROUP BY p_brand, p_type")
def _crosswalk_csv(m: Mapped) -> DataFrame:
    rows = m.raw("part").select(F.col("p_brand").alias("legacy_code"), F.concat(F.lit("STD-"), "p_partkey").alias("standard_code"), F.col("p_type").alias("source_system"), "p_partkey")
    path = scratch(m.spark, "crosswalk")
    rows.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").drop("p_partkey").write.option("header", True).csv(path)
    known = rows.where("legacy_code = 'Brand#1'").select("legacy_code", "source_system").distinct()
    return files.crosswalk_csv(m.spark, path, known)


_ISA = "ISA*00*          *00*          *ZZ*SENDER         *ZZ*RECEIVER       *240101*1200*^*00501*000000001*0*P*:~"
#: More diagnoses than any fixed width would hold.
_CODES = [f"D{i}" for i in range(45)]


def _amount(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _x12_claims(m: Mapped) -> DataFrame:
    return files.whole_texts(m.spark, _x12_claim_files(m, packed=True))


def _x12_claim_files(m: Mapped, packed: bool = False) -> str:
    """Files of 837 claims made of orders and their lines; ``packed`` ones where each is read whole."""
    lines = m.claim_lines().groupBy("claim_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_number", "cpt_code", "billed_amount", "units"))), lambda x: F.concat(F.lit("LX*1~SV1*HC:"), x["cpt_code"], F.lit("*"), x["billed_amount"].cast("string"), F.lit("*UN*"), x["units"].cast("string"), F.lit("~"))), "").alias("sv")
    )
    body = F.concat(
        F.lit("NM1*85*2*CLINIC*****XX*"), F.col("provider_npi").cast("string"), F.lit("~NM1*IL*1*DOE*JOHN****MI*"), F.col("patient_id").cast("string"), F.lit("~NM1*PR*2*PAYER*****PI*"), F.col("payer_id").cast("string"),
        F.lit("~CLM*"), F.col("claim_id").cast("string"), F.lit("*"), _amount("total_billed"), F.lit("***11:B:"), F.when(F.col("claim_id") % 5 == 0, "7").otherwise("1"),
        F.lit("~DTP*472*D8*"), F.date_format("date_of_service", "yyyyMMdd"), F.lit("~HI*" + "*".join("ABF:" + c for c in _CODES) + "~"), "sv",
    )
    where = scratch(m.spark, "records")
    with freed(m.spark):  # what the joins shuffled is gone before the texts are
        m.claims().drop("status").join(lines, "claim_id").write.option("compression", "zstd").parquet(where)
    records = m.spark.read.parquet(where)
    # Each order is a claim at most.
    return _files(m, records, "x837", "claim_id", body, head=_ISA + "ST*837*0001*005010X222A1~", tail="SE*1*1~", about=m.raw("orders").count(), packed=packed)


query("s5_segments", "SELECT 'CLM' AS tag, count(*) AS n FROM m_claims c WHERE claim_id IN (SELECT claim_id FROM m_lines) UNION ALL SELECT 'SV1', count(*) FROM m_lines l WHERE claim_id IN (SELECT claim_id FROM m_claims)")(
    lambda m: parsers.segments(_x12_claims(m)).where("tag in ('CLM', 'SV1')").groupBy("tag").agg(F.count("*").alias("n"))
)
query(
    "p1_claims_837",
    "SELECT CAST(claim_id AS VARCHAR) AS claim_id, CAST(total_billed AS DOUBLE) AS total_billed, CAST(provider_npi AS VARCHAR) AS provider_npi, CAST(patient_id AS VARCHAR) AS patient_id, CAST(payer_id AS VARCHAR) AS payer_id, strftime(date_of_service, '%Y%m%d') AS date_of_service, CASE WHEN claim_id % 5 = 0 THEN '7' ELSE '1' END AS frequency_code, CAST(45 AS BIGINT) AS n_codes, 'D44' AS last_code FROM m_claims WHERE claim_id IN (SELECT claim_id FROM m_lines)",
)(lambda m: parsers.claims_837(_x12_claims(m))[0].select("claim_id", "total_billed", "provider_npi", "patient_id", "payer_id", "date_of_service", "frequency_code", F.size("diagnosis_codes").alias("n_codes"), F.element_at("diagnosis_codes", -1).alias("last_code")))
query("p1_lines_837", "SELECT CAST(claim_id AS VARCHAR) AS claim_id, cpt_code, CAST(billed_amount AS DOUBLE) AS billed_amount, units FROM m_lines WHERE claim_id IN (SELECT claim_id FROM m_claims)")(
    lambda m: parsers.claims_837(_x12_claims(m))[1].select("claim_id", "cpt_code", "billed_amount", "units")
)


def _in_splits(m: Mapped, path: str) -> DataFrame:
    """Segments of files that are cut into splits of 64 kB, of which a task takes as many as make SPLIT_TASK_BYTES."""
    where = m.spark._jvm.org.apache.hadoop.fs.Path(path)
    size = where.getFileSystem(m.spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    tasks = max(m.spark.sparkContext.defaultParallelism, -(-size // SPLIT_TASK_BYTES))
    with setting(m.spark, spark__sql__files__maxPartitionBytes="64k", spark__sql__files__maxPartitionNum=str(tasks)):
        return parsers.split_segments(m.spark, path)


query("p1_claims_split", ORACLES["p1_claims_837"], whole=True)(
    lambda m: parsers.claim_heads(_in_splits(m, _x12_claim_files(m))).select("claim_id", "total_billed", "provider_npi", "patient_id", "payer_id", "date_of_service", "frequency_code", F.size("diagnosis_codes").alias("n_codes"), F.element_at("diagnosis_codes", -1).alias("last_code"))
)
query("p1_lines_split", ORACLES["p1_lines_837"], whole=True)(lambda m: parsers.service_lines(_in_splits(m, _x12_claim_files(m))).select("claim_id", "cpt_code", "billed_amount", "units"))


def _x12_remits(m: Mapped) -> DataFrame:
    """Files of 835 remittances made of lines."""
    rest = (F.col("allowed_amount") - F.col("paid_amount")).cast("decimal(18,2)").cast("string")
    body = F.concat(
        F.lit("CLP*"), F.col("claim_id").cast("string"), F.lit("*1*"), _amount("allowed_amount"), F.lit("*"), _amount("paid_amount"), F.lit("*0~CAS*CO*"),
        F.when(F.coalesce("denial_code", F.lit("")) == "", "45").otherwise(F.col("denial_code")), F.lit("*"), rest, F.lit("~CAS*PR*1*10.00~SVC*HC:T"), F.col("trace_number").cast("string"), F.lit("*1.00*2.00~"),
    )
    records = m.remittances().select(F.col("claim_id").alias("id"), body.alias("text"))
    return files.whole_texts(m.spark, _files(m, records, "x835", "id", "text", head=_ISA + "ST*835*1~TRN*1*TR9~DTM*405*20240201~N1*PR*AETNA*XX*AET~", tail="SE*1*1~"))


query(
    "p2_remittances_835",
    "SELECT CAST(claim_id AS VARCHAR) AS payer_claim_id, 'TR9' AS trace_number, 'AET' AS payer_id, CAST(allowed_amount AS DOUBLE) AS billed_amount, CAST(paid_amount AS DOUBLE) AS paid_amount, CAST(allowed_amount - paid_amount AS DOUBLE) AS co_amount, CAST(2 AS BIGINT) AS n_adjustments, 'T' || trace_number AS cpt_code FROM m_remits",
)(lambda m: parsers.remittances_835(_x12_remits(m)).select("payer_claim_id", "trace_number", "payer_id", "billed_amount", "paid_amount", F.get("adjustments", F.lit(0))["amount"].alias("co_amount"), F.size("adjustments").alias("n_adjustments"), F.get("service_lines", F.lit(0))["cpt_code"].alias("cpt_code")))
query("p3_denial_code", "SELECT CAST(claim_id AS VARCHAR) AS payer_claim_id, CAST(paid_amount AS DOUBLE) AS paid_amount, nullif(denial_code, '') AS denial_code FROM m_remits")(
    lambda m: parsers.remittances_835(_x12_remits(m)).select("payer_claim_id", "paid_amount", "denial_code")
)


def _adjusted(m: Mapped) -> DataFrame:
    codes = F.array(F.struct(F.lit("CO").alias("group_code"), F.when(F.coalesce("denial_code", F.lit("")) == "", "45").otherwise(F.col("denial_code")).alias("reason_code"), F.col("allowed_amount").alias("amount")), F.struct(F.lit("PR").alias("group_code"), F.lit("999").alias("reason_code"), F.col("paid_amount").alias("amount")))
    return m.remittances().join(m.claims().select("claim_id", "payer_id"), "claim_id").select("payer_id", codes.alias("adjustments"))


query(
    "z7_adjustment_mix",
    "SELECT c.payer_id, CAST(coalesce(sum(r.allowed_amount) FILTER (WHERE r.denial_code = '50'), 0) AS DOUBLE) AS denial, CAST(coalesce(sum(r.allowed_amount) FILTER (WHERE coalesce(r.denial_code, '') = ''), 0) AS DOUBLE) AS contractual, CAST(sum(r.paid_amount) AS DOUBLE) AS patient_resp, 0.0 AS informational FROM m_remits r JOIN m_claims c ON c.claim_id = r.claim_id GROUP BY c.payer_id",
)(lambda m: design.adjustment_mix(_adjusted(m), files.code_categories(m.spark)))
query(
    "s16_code_categories",
    "SELECT denial_code AS code, CASE denial_code WHEN '50' THEN 'denial' END AS category, count(*) AS n FROM m_remits WHERE denial_code IS NOT NULL GROUP BY denial_code",
)(lambda m: m.remittances().where("denial_code is not null").groupBy(F.col("denial_code").alias("code")).agg(F.count("*").alias("n")).join(files.code_categories(m.spark), "code", "left").select("code", "category", "n"))
query(
    "s16_seed_payers",
    "SELECT p.payer_id, p.state, count(c.claim_id) AS n FROM (VALUES ('AETNA', 0, 'CT'), ('BCBS_CA', 1, 'CA'), ('CIGNA', 2, 'CT'), ('MEDICAID_CA', 3, 'CA'), ('MEDICARE', 4, 'US'), ('UHC', 5, 'MN')) p(payer_id, k, state) JOIN m_claims c ON c.payer_id % 6 = p.k GROUP BY 1, 2",
)(lambda m: (lambda ids: m.claims().select("claim_id", F.element_at(F.array(*map(F.lit, ids)), (F.col("payer_id") % 6 + 1).cast("int")).alias("payer_id")).join(files.seed_payers(m.spark), "payer_id").groupBy("payer_id", "state").agg(F.count("claim_id").alias("n")))(sorted(p[0] for p in files.PAYERS)))


@query(
    "p4_patients_fhir",
    "SELECT CASE WHEN c_custkey % 3 = 0 THEN 'MR' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS patient_id, 'Ann B' AS first_name, c_name AS last_name, CAST(DATE '1980-02-03' + CAST(c_custkey % 5000 AS INT) AS DATE) AS dob, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'unknown' END AS gender, 'TX' AS state, c_mktsegment AS insurance_id FROM customer WHERE c_custkey % 11 <> 0",
)
def _fhir(m: Mapped) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    mr = F.array(F.struct(F.struct(F.array(F.struct(F.lit("MR").alias("code"))).alias("coding")).alias("type"), F.concat(F.lit("MR"), key).alias("value")))
    record = F.struct(
        F.when(F.col("c_custkey") % 11 == 0, "Observation").otherwise("Patient").alias("resourceType"),
        key.alias("id"),
        F.when(F.col("c_custkey") % 3 == 0, mr).alias("identifier"),
        F.array(F.struct(F.lit("nickname").alias("use"), F.lit("X").alias("family"), F.array(F.lit("Y")).alias("given")), F.struct(F.lit("official").alias("use"), F.col("c_name").alias("family"), F.array(F.lit("Ann"), F.lit("B")).alias("given"))).alias("name"),
        F.expr("date_add(date'1980-02-03', cast(c_custkey % 5000 as int))").cast("string").alias("birthDate"),
        F.when(F.col("c_custkey") % 2 == 0, "female").alias("gender"),
        F.array(F.struct(F.lit("home").alias("use"), F.lit("TX").alias("state"))).alias("address"),
        F.array(F.struct(F.lit("http://x/insurance-id").alias("url"), F.col("c_mktsegment").alias("valueString"))).alias("extension"),
    )
    records = m.raw("customer").select("c_custkey", F.to_json(record).alias("text"))
    path = _files(m, records, "fhir", "c_custkey", "text", join=",", head="[", tail="]")
    return parsers.patients_fhir(files.json_records(m.spark, path, schemas.FHIR_PATIENT)).select("patient_id", "first_name", "last_name", "dob", "gender", "state", "insurance_id")


def _hl7(m: Mapped) -> tuple[DataFrame, DataFrame]:
    key = F.col("c_custkey").cast("string")
    kind = F.when(F.col("c_custkey") % 7 == 0, "ORU^R01").otherwise("ADT^A01")
    text = F.concat(F.lit("MSH|^~\\&|A|B|C|D|20240101||"), kind, F.lit("|1|P|2.5\rPID|1||"), key, F.lit("^^^H||"), "c_name", F.lit("^ANN||19800102|F|||1 ST^^TOWN^TX^75001\rIN1|1|"), "c_mktsegment", F.lit("\r"))
    path = _files(m, m.raw("customer").select("c_custkey", text.alias("text")), "hl7", "c_custkey", "text")
    return parsers.patients_hl7(parsers.hl7_messages(files.whole_texts(m.spark, path)))


query("p5_patients_hl7", "SELECT CAST(c_custkey AS VARCHAR) AS patient_id, 'ANN' AS first_name, c_name AS last_name, DATE '1980-01-02' AS dob, 'female' AS gender, 'TOWN' AS city, '75001' AS zip, c_mktsegment AS insurance_id FROM customer WHERE c_custkey % 7 <> 0")(
    lambda m: _hl7(m)[0].select("patient_id", "first_name", "last_name", "dob", "gender", "city", "zip", "insurance_id")
)
query("s6_hl7_messages", "SELECT count(*) AS rejected FROM customer WHERE c_custkey % 7 = 0")(lambda m: _hl7(m)[1].agg(F.count("*").alias("rejected")))


def _eobs(m: Mapped) -> DataFrame:
    """Extracted EOBs made of remittances, as JSON files."""
    value = lambda c, sure: F.struct(c.cast("string").alias("value"), sure.cast("double").alias("confidence"))
    n = F.col("claim_id") * 10 + F.col("trace_number")
    sure = F.when(n % 4 == 0, F.lit(0.5)).otherwise(F.lit(0.95))
    fields = F.create_map(F.when(n % 2 == 0, "ClaimNumber").otherwise("Claim_No"), value(F.col("claim_id"), sure), F.lit("PaymentAmount"), value(F.col("paid_amount"), F.lit(0.8)))
    record = F.struct(F.concat(F.lit("eob-"), n.cast("string")).alias("source_file"), F.lit("P").alias("payer_id"), fields.alias("fields"), sure.alias("avg_confidence"))
    path = _files(m, m.remittances().select(n.alias("n"), F.to_json(record).alias("text")), "eob", "n", "text", join=",", head="[", tail="]")
    return files.json_records(m.spark, path, schemas.EOB)


query("p6_eob_fields", "SELECT 'eob-' || (claim_id * 10 + trace_number) AS source_file, CAST(claim_id AS VARCHAR) AS claim_number, CASE WHEN (claim_id * 10 + trace_number) % 4 = 0 THEN 0.5 ELSE 0.95 END AS claim_number_confidence, CAST(CAST(paid_amount AS VARCHAR) AS DOUBLE) AS paid_amount, 0.0 AS check_number_confidence FROM m_remits")(
    lambda m: parsers.eob_fields(_eobs(m)).select("source_file", "claim_number", "claim_number_confidence", F.col("paid_amount").cast("double").alias("paid_amount"), "check_number_confidence")
)
query("p7_content_hash", "SELECT doc_id, sha256(CASE WHEN trim(coalesce(text, '')) = '' THEN 'file-' || doc_id ELSE text END) AS content_hash FROM documents")(
    lambda m: parsers.content_hash(m.raw("documents").select("doc_id", F.concat(F.lit("file-"), "doc_id").alias("file"), F.col("text").alias("content"))).select("doc_id", "content_hash")
)


@query("p8_contract_rates", "SELECT 'contract-' || p_brand AS source_file, p_type || '/' || p_partkey AS cpt_code, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS rate, 'needs_review' AS status FROM part")
def _contracts(m: Mapped) -> DataFrame:
    cell = F.create_map(F.lit("col_0"), F.concat("p_type", F.lit("/"), "p_partkey"), F.lit("col_1"), F.concat(F.lit("$"), F.format_number("p_retailprice", 2)))
    head = F.create_map(F.lit("col_0"), F.lit("CPT"), F.lit("col_1"), F.lit("Rate"))
    rows = m.raw("part").select(F.concat(F.lit("contract-"), "p_brand").alias("source_file"), F.pmod("p_partkey", F.lit(8)).alias("k"), cell.alias("c"))
    tables = rows.groupBy("source_file", "k").agg(F.concat(F.array(head), F.collect_list("c")).alias("t")).groupBy("source_file").agg(F.collect_list("t").alias("tables"))
    record = F.struct("source_file", F.lit("P").alias("payer_id"), F.lit("N").alias("provider_npi"), F.lit("2024-01-01").alias("effective_date"), "tables")
    path = _files(m, tables.select("source_file", F.to_json(record).alias("text")), "contract", "source_file", "text", join=",", head="[", tail="]")
    return parsers.contract_rates(files.json_records(m.spark, path, schemas.CONTRACT)).select("source_file", "cpt_code", "rate", "status")


def _texts(m: Mapped) -> str:
    """A file a supplier, with its name."""
    path = scratch(m.spark, "texts")
    key = F.col("s_suppkey").alias("file_no")
    sinks.text_files(m.raw("supplier").select(key, _folder(F.col("s_suppkey")), F.concat(F.lit("Section "), key.cast("string"), F.lit(". Rule\nof "), "s_name").alias("text")), path, [])
    return path


query("s9_whole_texts", "SELECT 'Section ' || s_suppkey || '. Rule' AS section_title, CAST(0 AS BIGINT) AS section_index, 'Section ' || s_suppkey || '. Rule' || chr(10) || 'of ' || s_name AS chunk_text FROM supplier")(
    lambda m: parsers.chunks(files.whole_texts(m.spark, _texts(m)).withColumn("cfr_citation", F.lit("45"))).select("section_title", "section_index", "chunk_text")
)
query("s10_binary_documents", "SELECT length(t) AS length, sha256(t) AS content_hash FROM (SELECT 'Section ' || s_suppkey || '. Rule' || chr(10) || 'of ' || s_name || chr(10) AS t FROM supplier) t")(
    lambda m: files.binary_documents(m.spark, _texts(m)).select("length", "content_hash")
)


@query("s12_partitioned", "SELECT CAST(ts AS DATE) AS cdc_date, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15' GROUP BY 1")
def _partitioned(m: Mapped) -> DataFrame:
    path = scratch(m.spark, "bronze")
    sinks.append_bronze(merge.enrich_bronze(m.cdc(), "events"), path)
    return files.partitioned(m.spark, path, "2024-01-15").groupBy("cdc_date").agg(F.count("*").alias("n"))


@query("s13_tolerant", "SELECT s_suppkey, s_name FROM supplier")
def _tolerant(m: Mapped) -> DataFrame:
    path = scratch(m.spark, "mixed")
    m.raw("supplier").select("s_suppkey", "s_name").write.parquet(f"{path}/good")
    m.raw("supplier").select("s_name").write.text(f"{path}/bad")
    return files.tolerant(m.spark, path)


@query("s11_jdbc_incremental", "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders UNION ALL SELECT o_orderkey + 100000000, 'N', 1.0 FROM orders WHERE o_orderkey % 7 = 0")
def _jdbc(m: Mapped) -> DataFrame:
    """Orders in an embedded database, of which new ones come between two loads (a database that a local master's tasks reach)."""
    url = f"jdbc:derby:memory:{scratch(m.spark, 'db').rsplit('/', 1)[1].replace('-', '')};create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = m.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice").coalesce(2)
    rows.write.jdbc(url, "orders", properties=driver | {"createTableColumnTypes": "o_orderstatus varchar(8)"})
    path = scratch(m.spark, "jdbc")
    files.jdbc_load(m.spark, url, "orders", "o_orderkey", path, **driver)
    late = rows.where("o_orderkey % 7 = 0").select((F.col("o_orderkey") + 100_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"))
    late.write.mode("append").jdbc(url, "orders", properties=driver)
    for _ in range(2):  # the second load finds nothing
        files.jdbc_load(m.spark, url, "orders", "o_orderkey", path, **driver)
    return VersionedTable(m.spark, path).read()


query("s14_table_or_empty", "SELECT s_suppkey, s_name FROM supplier")(
    lambda m: files.table_or_empty(m.spark, f"{m.sf_dir}/supplier.parquet", m.raw("supplier").select("s_suppkey", "s_name").schema).unionByName(files.table_or_empty(m.spark, f"{scratch(m.spark, 'none')}", m.raw("supplier").select("s_suppkey", "s_name").schema))
)


def _supplier_csv(m: Mapped) -> str:
    return _csv(m, m.raw("supplier").select(F.col("s_suppkey").alias("Key"), F.when(F.col("s_suppkey") % 6 == 0, "?").otherwise(F.col("s_acctbal").cast("decimal(18,2)").cast("string")).alias("Balance"), F.lit("01/02/2024").alias("Since"), F.lit("x").alias("Extra")), "supplier")


query("s15_mapped_csv", "SELECT s_suppkey AS npi, CASE WHEN s_suppkey % 6 <> 0 THEN CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS balance, DATE '2024-01-02' AS since FROM supplier")(
    lambda m: files.mapped_csv(m.spark, _supplier_csv(m), {"Key": ("npi", "bigint"), "Balance": ("balance", "decimal(18,2)"), "Since": ("since", "date")})
)
query(
    "z11_drift",
    "SELECT 'Balance' AS column_name, 'present' AS state, count(*) FILTER (WHERE s_suppkey % 6 = 0) / count(*) AS misfit_rate FROM supplier UNION ALL SELECT 'Key', 'present', 0.0 UNION ALL SELECT 'Gone', 'missing', NULL UNION ALL SELECT 'Since', 'unexpected', NULL UNION ALL SELECT 'Extra', 'unexpected', NULL",
)(lambda m: files.drift(m.spark, _supplier_csv(m), {"Key": "bigint", "Balance": "decimal(18,2)", "Gone": "int"}))

# ---- K: writers


@query("k2_upsert_table", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'changed' ELSE s_name END AS s_name FROM supplier WHERE s_suppkey % 9 <> 1 UNION ALL SELECT s_suppkey + 1000000, 'new' FROM supplier WHERE s_suppkey % 4 = 0")
def _upsert_table(m: Mapped) -> DataFrame:
    table = VersionedTable(m.spark, scratch(m.spark, "upsert"))
    old = m.raw("supplier").select("s_suppkey", "s_name")
    table.upsert(old, ["s_suppkey"], buckets=8)
    some = old.where("s_suppkey % 4 = 0")
    changes = some.withColumn("s_name", F.lit("changed")).where("s_suppkey % 9 <> 1").unionByName(some.select((F.col("s_suppkey") + 1_000_000).alias("s_suppkey"), F.lit("new").alias("s_name")))
    table.upsert(changes, ["s_suppkey"], gone=old.where("s_suppkey % 9 = 1"))
    return table.read()


@query(
    "k2_snapshots",
    "SELECT v AS version, o_orderkey, CASE WHEN o_orderkey % 10 < v THEN o_orderpriority || '+' ELSE o_orderpriority END AS o_orderpriority, CASE WHEN o_orderkey % 10 < v THEN CAST(o_orderkey % 10 AS BIGINT) + 1 ELSE 0 END AS written_by FROM orders, (VALUES (0), (4), (10)) t(v) WHERE NOT (o_orderkey % 13 = 0 AND o_orderkey % 10 < v)",
)
def _snapshots(m: Mapped) -> DataFrame:
    """Ten upserts with deletes; the rows of three versions, and who wrote them."""
    table = VersionedTable(m.spark, scratch(m.spark, "snapshots"))
    rows = m.raw("orders").select("o_orderkey", "o_orderpriority", F.lit(0).alias("written_by"))
    table.upsert(rows, ["o_orderkey"], buckets=4)
    for turn in range(10):
        mine = rows.where(F.col("o_orderkey") % 10 == turn)
        changed = mine.where("o_orderkey % 13 <> 0").withColumns({"o_orderpriority": F.concat("o_orderpriority", F.lit("+")), "written_by": F.lit(turn + 1)})
        table.upsert(changed, ["o_orderkey"], gone=mine.where("o_orderkey % 13 = 0"))
    out = [table.read(v).withColumn("version", F.lit(v)) for v in (0, 4, 10)]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("k3_overwrite", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def _overwrite(m: Mapped) -> DataFrame:
    path = scratch(m.spark, "current")
    rows = m.raw("supplier").select("s_suppkey", "s_name")
    sinks.overwrite(rows, path)
    sinks.overwrite(rows.where("s_suppkey % 2 = 0"), path)
    return m.spark.read.parquet(path)


@query("k4_write_gold", "SELECT g1.*, (SELECT count(*) FROM g1) AS rows_written FROM g1")
def _write_gold(m: Mapped) -> DataFrame:
    path = scratch(m.spark, "gold")
    seen = sinks.write_gold(Gold(m)["recovery"], path)
    return m.spark.read.parquet(path).drop("_gold_ts").withColumn("rows_written", F.lit(seen["rows"]))


@query("q5_stale", "SELECT 45.0 AS age_minutes, TRUE AS is_stale FROM (SELECT count(*) AS n FROM nation) t")
def _stale(m: Mapped) -> DataFrame:
    rows = m.raw("events").withColumn("_gold_ts", F.expr("timestamp'2024-01-01 00:00:00' - make_interval(0, 0, 0, 0, 0, 0, event_id)"))
    newest = rows.agg(F.max("_gold_ts").alias("t")).select((F.col("t") + F.expr("interval 45 minutes")).alias("t")).first()["t"]
    return quality.stale(rows, F.lit(newest))


# ---- ingest end to end


def _incoming(m: Mapped) -> DataFrame:
    """Three records a claim in order of arrival: as known, replaced, and for some voided or replaced once more."""
    placed = m.claim_lines().repartition(m.tasks("lineitem", mapped.LISTED_PER_TASK), "claim_id")  # all that follows is by claim, in these tasks
    lines = placed.groupBy("claim_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_number", "cpt_code"))), lambda x: F.struct(x["cpt_code"].alias("cpt_code"))).alias("lines"))
    base = m.claims().join(lines, "claim_id").select("claim_id", "total_billed", "lines")
    money = lambda c: c.cast("decimal(18,2)")
    record = lambda cond, code, n, total, of: F.when(cond, F.struct(F.lit(code).alias("frequency_code"), F.lit(n).alias("arrival"), total.alias("total_billed"), of.alias("lines")))
    n, total, every = F.col("claim_id"), F.col("total_billed"), F.col("lines")
    records = F.array_compact(F.array(record(F.lit(True), "1", 1, total, every), record(n % 3 == 0, "8", 2, total, every), record(n % 2 == 0, "7", 3, money(total + 1), F.slice("lines", 1, 1)), record(n % 5 == 0, "8", 4, total, every)))
    return base.select("claim_id", F.explode(records).alias("r")).select("claim_id", "r.*")


def _stored(m: Mapped) -> tuple[DataFrame, DataFrame]:
    claims = m.claims().where("claim_id % 4 = 0").select("claim_id", "total_billed", F.lit("filed").alias("status"))
    return claims, m.claim_lines().where("claim_id % 4 = 0").join(claims.select("claim_id"), "claim_id", "left_semi").select("claim_id", "line_number", "cpt_code")


_HAS_LINES = "claim_id IN (SELECT claim_id FROM m_lines)"
_AFTER = f"SELECT claim_id, CAST(total_billed + CASE WHEN claim_id % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS total_billed, CASE WHEN claim_id % 5 = 0 THEN 'voided' WHEN claim_id % 2 = 0 THEN 'corrected' WHEN claim_id % 3 = 0 THEN 'voided' ELSE 'received' END AS status FROM m_claims WHERE {_HAS_LINES}"
_AFTER_LINES = "SELECT c.claim_id, count(*) AS n_lines FROM (SELECT claim_id FROM m_claims) c JOIN m_lines l ON l.claim_id = c.claim_id WHERE c.claim_id % 2 = 1 GROUP BY c.claim_id UNION ALL SELECT claim_id, 1 FROM m_claims WHERE claim_id % 2 = 0 AND claim_id IN (SELECT claim_id FROM m_lines)"
_UNTOUCHED = " UNION ALL SELECT claim_id, CAST(total_billed AS DOUBLE), 'filed' FROM m_claims WHERE claim_id % 4 = 0 AND claim_id NOT IN (SELECT claim_id FROM m_lines)"


@query("e2_apply_actions", _AFTER + _UNTOUCHED)
def _apply(m: Mapped) -> DataFrame:
    claims, lines = _stored(m)
    return ingest.apply_claim_actions(claims, lines, ingest.claim_actions(_incoming(m), claims))[0]


@query("e2_apply_lines", _AFTER_LINES)
def _apply_lines(m: Mapped) -> DataFrame:
    claims, lines = _stored(m)
    return ingest.apply_claim_actions(claims, lines, ingest.claim_actions(_incoming(m), claims))[1].groupBy("claim_id").agg(F.count("*").alias("n_lines"))


query("k9_audit", "SELECT 'claim' AS entity_type, CAST(claim_id AS VARCHAR) AS entity_id, 'void' AS action, 'system' AS user_id FROM m_claims WHERE claim_id % 3 = 0 AND claim_id IN (SELECT claim_id FROM m_lines) UNION ALL SELECT 'claim', CAST(claim_id AS VARCHAR), 'void', 'system' FROM m_claims WHERE claim_id % 5 = 0 AND claim_id IN (SELECT claim_id FROM m_lines)")(
    lambda m: ingest.audit(ingest.claim_actions(_incoming(m), _stored(m)[0]).where("action = 'void'"), "claim", "claim_id", "void").drop("timestamp")
)


def _remit_feed(m: Mapped) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    n = F.col("claim_id")
    key = F.when(n % 3 == 0, n.cast("string")).when(n % 3 == 1, F.concat(F.lit("00"), n.cast("string"))).otherwise(F.concat(F.lit("A-"), n.cast("string")))
    parsed = m.remittances().select(key.alias("payer_claim_id"), F.col("trace_number").cast("string").alias("trace_number"), F.lit("P").alias("payer_id"), F.when(n % 7 != 0, F.col("paid_amount")).alias("paid_amount"), F.array(F.lit("x")).alias("adjustments"), F.col("era_date"))
    claims = m.claims().select(n.cast("string").alias("claim_id"))
    alias = m.claims().where("claim_id % 2 = 0").select(F.concat(F.lit("A-"), n.cast("string")).alias("payer_claim_id"), F.lit("P").alias("payer_id"), n.cast("string").alias("claim_id"))
    known = m.remittances().where("claim_id % 10 = 0").select(n.cast("string").alias("claim_id"), F.col("trace_number").cast("string").alias("trace_number"), F.lit("P").alias("payer_id"))
    return parsed, claims, alias, known


_MATCHED = "(claim_id % 3 <> 2 OR claim_id % 2 = 0)"

query("e10_ingest_remittances", f"SELECT DISTINCT CAST(claim_id AS VARCHAR) AS claim_id, CAST(trace_number AS VARCHAR) AS trace_number, CASE claim_id % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'normalised' ELSE 'alias' END AS matched_by FROM m_remits WHERE claim_id % 7 <> 0 AND claim_id % 10 <> 0 AND {_MATCHED} AND claim_id IN (SELECT claim_id FROM m_claims)")(
    lambda m: ingest.ingest_remittances(*_remit_feed(m))["new"].select("claim_id", "trace_number", "matched_by")
)
query("e6_route_unmatched", f"SELECT 'unmatched_reference' AS error_category, 'A-' || claim_id AS entity_id, 'No claim for A-' || claim_id AS error_detail FROM m_remits WHERE claim_id % 7 <> 0 AND NOT {_MATCHED} UNION ALL SELECT 'validation_failure', CASE claim_id % 3 WHEN 0 THEN '' WHEN 1 THEN '00' ELSE 'A-' END || claim_id, 'Missing paid_amount' FROM m_remits WHERE claim_id % 7 = 0")(
    lambda m: ingest.ingest_remittances(*_remit_feed(m))["dead_letters"].select("error_category", "entity_id", "error_detail")
)


@query("e8_ingest_backfill", "SELECT 'new' AS part, count(*) AS n FROM m_claims WHERE claim_id % 4 = 0 AND claim_id IN (SELECT claim_id FROM m_lines) UNION ALL SELECT 'skipped', count(*) FROM m_claims WHERE claim_id % 4 >= 2 AND claim_id IN (SELECT claim_id FROM m_lines) UNION ALL SELECT 'review', count(*) FROM m_claims WHERE claim_id % 4 = 1 AND claim_id IN (SELECT claim_id FROM m_lines) UNION ALL SELECT 'dead_letters', count(*) FROM m_claims WHERE claim_id NOT IN (SELECT claim_id FROM m_lines)")
def _ingest_backfill(m: Mapped) -> DataFrame:
    lines = m.claim_lines().groupBy("claim_id").agg(F.collect_list(F.struct("cpt_code")).alias("lines"))
    same = m.claims().join(lines, "claim_id", "left").withColumns({"payer_id": F.col("payer_id").cast("string"), "provider_npi": F.col("provider_npi").cast("string"), "diagnosis_codes": F.array(F.lit("D"))})
    incoming = same.withColumn("total_billed", F.when(F.col("claim_id") % 4 == 1, F.col("total_billed") + 1).otherwise(F.col("total_billed")).cast("decimal(18,2)"))
    table = m.spark.createDataFrame([("Brand#1", "STD-1", "s")], "legacy_code string, standard_code string, source_system string")
    out = ingest.ingest_backfill(incoming, same.where("claim_id % 4 <> 0"), table)
    return reports.row_counts(out).withColumnRenamed("table_name", "part")


_EOB = "(SELECT DISTINCT claim_id, (claim_id * 10 + trace_number) AS n FROM m_remits) e"


@query(
    "e11_ingest_eobs",
    f"SELECT 'artifacts' AS part, count(*) AS n FROM {_EOB} UNION ALL SELECT 'remittances', count(*) FROM {_EOB} WHERE n % 4 <> 0 AND claim_id IN (SELECT claim_id FROM m_claims) UNION ALL SELECT 'review', count(*) FROM {_EOB} WHERE n % 4 = 0 UNION ALL SELECT 'unmatched', count(*) FROM {_EOB} WHERE n % 4 <> 0 AND claim_id NOT IN (SELECT claim_id FROM m_claims)",
)
def _ingest_eobs(m: Mapped) -> DataFrame:
    parsed = parsers.eob_fields(_eobs(m))
    claims = m.claims().select(F.col("claim_id").cast("string").alias("claim_id"))
    none = m.spark.createDataFrame([], "payer_claim_id string, payer_id string, claim_id string")
    hashed = parsed.withColumn("content_hash", F.sha2("source_file", 256))
    return reports.row_counts(ingest.ingest_eobs(hashed, claims, none, hashed.select("content_hash").limit(0))).withColumnRenamed("table_name", "part")


@query("e12_upsert_patients", "SELECT c_custkey AS patient_id, CASE WHEN c_custkey % 3 = 0 THEN 'hl7v2' WHEN c_custkey % 2 = 0 THEN 'fhir' ELSE 'stored' END AS source_system, CASE WHEN c_custkey % 3 = 0 THEN 3 WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS last_updated FROM customer")
def _patients(m: Mapped) -> DataFrame:
    base = m.raw("customer").select(F.col("c_custkey").alias("patient_id"))
    feed = lambda name, at, cond: base.where(cond).withColumns({"source_system": F.lit(name), "last_updated": F.lit(at)})
    return ingest.upsert_patients(feed("stored", 1, "true"), feed("fhir", 2, "patient_id % 2 = 0"), feed("hl7v2", 3, "patient_id % 3 = 0"), feed("old", 0, "patient_id % 3 = 0"))


query("e13_ingest_documents", "SELECT content_hash, min(doc_id) AS doc_id FROM (SELECT sha256(text) AS content_hash, doc_id FROM documents) d WHERE content_hash NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 5 = 0 AND text IS NOT NULL) GROUP BY content_hash")(
    lambda m: (lambda d: ingest.ingest_documents(d, d.where("filename % 5 = 0"))["new"].select("content_hash", F.col("filename").alias("doc_id")))(m.raw("documents").where("text is not null").select(F.col("doc_id").alias("filename"), F.sha2("text", 256).alias("content_hash")))
)
query("v3_validate_patients", "SELECT c_custkey AS patient_id, CASE WHEN c_custkey % 4 = 0 THEN 'Missing dob' ELSE '' END AS errors, CASE WHEN c_custkey % 3 = 0 THEN 'Missing last_name' ELSE '' END AS warnings FROM customer")(
    lambda m: ingest.validate_patients(m.raw("customer").select(F.col("c_custkey").cast("string").alias("patient_id"), F.when(F.col("c_custkey") % 4 != 0, "2000-01-01").alias("dob"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise(" ").alias("last_name"), F.col("c_mktsegment").alias("insurance_id"))).select(F.col("patient_id").cast("long").alias("patient_id"), F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"))
)
query("v5_validate_providers", "SELECT name, CASE WHEN npi % 5 = 0 THEN 'Missing npi' ELSE '' END AS errors, CASE WHEN npi % 2 = 0 THEN 'Missing specialty_taxonomy; Missing state' ELSE 'Missing state' END AS warnings FROM m_providers")(
    lambda m: ingest.validate_providers(m.providers().select("name", F.when(F.col("npi") % 5 != 0, F.col("npi").cast("string")).alias("npi"), F.when(F.col("npi") % 2 != 0, F.col("specialty")).alias("specialty_taxonomy"), F.lit("").alias("state"))).select("name", F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"))
)


@query(
    "m3_provider_scd2",
    "SELECT npi, state, CAST(valid_from AS DATE) AS valid_from, CAST(valid_to AS DATE) AS valid_to, is_current, merge_action FROM (SELECT npi, state, DATE '2019-01-01' AS valid_from, CASE WHEN npi % 3 = 0 THEN DATE '2020-12-31' WHEN npi % 2 = 0 THEN DATE '2021-12-31' ELSE DATE '9999-12-31' END AS valid_to, CASE WHEN npi % 3 = 0 OR npi % 2 = 0 THEN 0 ELSE 1 END AS is_current, CASE WHEN npi % 3 = 0 OR npi % 2 = 0 THEN 'closed' ELSE 'unchanged' END AS merge_action FROM m_providers UNION ALL SELECT npi, 'MOVED', DATE '2021-01-01', CASE WHEN npi % 2 = 0 THEN DATE '2021-12-31' ELSE DATE '9999-12-31' END, CASE WHEN npi % 2 = 0 THEN 0 ELSE 1 END, 'inserted' FROM m_providers WHERE npi % 3 = 0 UNION ALL SELECT npi, 'AGAIN', DATE '2022-01-01', DATE '9999-12-31', 1, 'inserted' FROM m_providers WHERE npi % 2 = 0 UNION ALL SELECT npi, 'FORMER', DATE '2010-01-01', DATE '2018-12-31', 0, 'history' FROM m_providers) t",
)
def _provider_scd2(m: Mapped) -> DataFrame:
    day = lambda d: F.lit(d).cast("date")
    base = m.providers().select("npi", "state")
    current = base.withColumns({"valid_from": day("2019-01-01"), "valid_to": day("9999-12-31"), "is_current": F.when(F.col("npi") % 4 != 0, 1)})
    former = base.withColumns({"state": F.lit("FORMER"), "valid_from": day("2010-01-01"), "valid_to": day("2018-12-31"), "is_current": F.lit(0)})
    moved = base.where("npi % 3 = 0").withColumns({"state": F.lit("MOVED"), "effective_date": day("2021-01-01")})
    again = base.where("npi % 2 = 0").withColumns({"state": F.lit("AGAIN"), "effective_date": day("2022-01-01")})
    same = again.withColumn("effective_date", day("2023-01-01"))
    out = merge.scd2_merge(current.unionByName(former), moved.unionByName(again).unionByName(same), ["npi"], ["state"])
    return out.withColumn("is_current", F.when((F.col("merge_action") == "unchanged"), 1).otherwise(F.col("is_current")))


@query("z8_duplicate_patients", "SELECT upper(c_mktsegment) AS record_no, count(*) AS n, min(c_custkey) AS first_id, max(c_custkey) AS last_id FROM customer GROUP BY c_mktsegment, c_nationkey HAVING count(*) > 1")
def _duplicate_patients(m: Mapped) -> DataFrame:
    rows = m.raw("customer").select(F.col("c_custkey").alias("patient_id"), F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("insurance_id"), F.lit("2000-01-01").alias("dob"), F.col("c_nationkey").cast("string").alias("last_name"))
    return design.duplicate_patients(rows).select("record_no", "n", "first_id", "last_id")


def _roster(m: Mapped) -> tuple[DataFrame, DataFrame, DataFrame]:
    stored = m.providers().select("npi", "state")
    _, state = merge.snapshot_diff(stored.where("npi % 5 <> 0"), ["npi"], None, "roster")
    roster = stored.where("npi % 7 <> 0").withColumn("state", F.when(F.col("npi") % 3 == 0, "MOVED").otherwise(F.col("state")))
    return design.reconcile_roster(stored, roster, ["npi"], state)


query("z9_reconcile_roster", "SELECT npi, CASE WHEN npi % 7 <> 0 AND npi % 3 = 0 THEN 'MOVED' ELSE state END AS state FROM m_providers")(lambda m: _roster(m)[2])
query("z9_roster_events", "SELECT CASE WHEN npi % 5 = 0 THEN 'I' WHEN npi % 7 = 0 THEN 'D' ELSE 'U' END AS _cdc_operation, '{\"npi\":' || npi || '}' AS row_pk FROM m_providers WHERE (npi % 5 = 0 AND npi % 7 <> 0) OR (npi % 5 <> 0 AND (npi % 7 = 0 OR npi % 3 = 0))")(
    lambda m: _roster(m)[0].select("_cdc_operation", "row_pk")
)
query("z14_mapping_status", "SELECT c.claim_id, CASE WHEN bool_or(l.cpt_code = 'Brand#1') THEN 'mapped' ELSE 'unchanged' END AS mapping_status FROM m_claims c JOIN m_lines l ON l.claim_id = c.claim_id GROUP BY c.claim_id")(
    lambda m: ingest.apply_crosswalk(m.claims().select("claim_id", F.col("payer_id").cast("string").alias("payer_id")).join(m.claim_lines().groupBy("claim_id").agg(F.collect_list(F.struct("cpt_code")).alias("lines")), "claim_id"), m.spark.createDataFrame([("Brand#1", "STD-1", "s")], "legacy_code string, standard_code string, source_system string"), "s").select("claim_id", "mapping_status")
)

# ---- orchestration


@query("g14_run_all", "SELECT 'recovery' AS table_name, count(*) AS n FROM g1 UNION ALL SELECT 'aging', count(*) FROM g5 UNION ALL SELECT 'deadlines', count(*) FROM g7 UNION ALL SELECT 'broken at run time', 0 UNION ALL SELECT 'broken plan', 0")
def _run_all(m: Mapped) -> DataFrame:
    base, gold = scratch(m.spark, "run"), Gold(m)
    builders = {k: gold.builders[k] for k in ("recovery", "aging", "deadlines")}
    builders |= {"broken at run time": lambda: m.claims().select(F.raise_error(F.lit("no")).alias("x")), "broken plan": lambda: m.claims().select("none")}
    built, failed = gold_plans.run_all(builders, lambda name, df: sinks.write_gold(df, f"{base}/{name.replace(' ', '_')}"))
    empty = m.spark.createDataFrame([], "a int")
    return reports.row_counts({k: m.spark.read.parquet(f"{base}/{k}") for k in built} | {k: empty for k in failed})


@query("t10_refresh", "SELECT 'silver_claims' AS table_name, count(*) AS n FROM m_claims UNION ALL SELECT 'silver_claim_remittance', count(*) FROM cr UNION ALL SELECT 'silver_fee_schedule', count(*) FROM h_fees UNION ALL SELECT 'silver_disputes', count(*) FROM dsp")
def _refresh(m: Mapped) -> DataFrame:
    base = scratch(m.spark, "silver")
    bad = m.providers().select(F.raise_error(F.lit("no")).cast("string").alias("npi"), *[F.lit("").alias(c) for c in ("name", "specialty", "facility_name", "state")], F.lit(None).cast("date").alias("valid_from"), F.lit(1).alias("is_current"))
    tables = {"claims": m.claims(), "claim_lines": m.claim_lines(), "remittances": m.remittances().limit(0).select("claim_id"), "payers": m.payers(), "fee_schedule": fees(m), "disputes": workload.disputes(m).drop("payer_id", "payer_name", "provider_npi"), "providers": bad}
    tables["remittances"] = m.remittances()
    built, _ = silver.refresh(tables, AS_OF, lambda name, df: df.write.parquet(f"{base}/{name}"))
    return reports.row_counts({k: m.spark.read.parquet(f"{base}/{k}") for k in built if k != "silver_remittances"})


query("r7_bundle", "SELECT 'recovery' AS table_name, count(*) AS n FROM g1 UNION ALL SELECT 'underpayment', least(20, count(*)) FROM g8 UNION ALL SELECT 'aging', count(*) FROM g5")(
    lambda m: (lambda g: reports.row_counts(reports.bundle({k: g[k] for k in ("recovery", "underpayment", "aging")})))(Gold(m))
)


@query("w11_metric_alerts", "SELECT 'dlq_depth' AS metric, CAST(count(*) AS DOUBLE) AS value, 50.0 AS threshold, count(*) > 50 AS alert FROM m_remits WHERE claim_id % 7 = 0 UNION ALL SELECT 'parse_failure_pct', 0.0, 5.0, FALSE UNION ALL SELECT 'unmatched_pct', 0.0, 10.0, FALSE UNION ALL SELECT 'avg_confidence_pct', 80.0, 85.0, TRUE")
def _metrics(m: Mapped) -> DataFrame:
    letters = ingest.ingest_remittances(*_remit_feed(m))["dead_letters"].where("error_category = 'validation_failure'")
    return workflow.metric_alerts(letters, m.remittances().count(), m.remittances().select(F.lit(0.8).alias("confidence")))


def _requests(m: Mapped) -> tuple[DataFrame, DataFrame]:
    """Of each case two requests: to close it (late) and to take it into review (early)."""
    cases = workload.cases(m)
    ask = lambda to, at: cases.select("case_id", F.lit(to).alias("target_status"), F.lit(at).alias("arrival"))
    return cases, workflow.judge_transitions(ask("closed", 2).unionByName(ask("in_review", 1)).unionByName(ask("negotiation", 3)), cases)


query("w9_apply", "SELECT case_id, CASE WHEN status = 'open' THEN 'closed' WHEN status IN ('in_review', 'negotiation', 'idr_initiated', 'idr_submitted', 'decided') THEN 'closed' ELSE status END AS status FROM cs")(
    lambda m: workflow.apply_transitions(*_requests(m), AS_OF).select("case_id", "status")
)
query(
    "w9_deadlines",
    "SELECT dl.case_id, deadline_type, CASE WHEN dl.status = 'pending' AND cs.status <> 'closed' THEN 'met' ELSE dl.status END AS status FROM dl JOIN cs ON cs.case_id = dl.case_id",
)(lambda m: workflow.transition_deadlines(workload.deadlines(m), workload.disputes(m), _requests(m)[1], AS_OF).select("case_id", "deadline_type", "status"))
