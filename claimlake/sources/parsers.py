"""Healthcare formats as set-based Spark jobs: a row a segment or a claim, context carried forward by windows.

X12 files come as (file, content), or in splits of any size (:func:`split_segments`). Their text is cut in the task
that reads it; of claims one short row each is shuffled. What a row takes from those before it is carried forward
inside its split first, then from split to split by one scan over the splits' last values, so one large interchange
parses in as many tasks as it has splits.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import blank, money
from ..session import scratch

#: Files, about, whose headers are sent to every task.
BROADCAST_ROWS = 500_000


def _runs(files: DataFrame) -> DataFrame:
    """X12 files that begin with ISA as one run each: file, block (0), pos (0), sep and its segments as texts, some of
    them empty. Separators are the characters at 3 and 105."""
    element, end = F.substring("content", 4, 1), F.substring("content", 106, 1)
    without = lambda c, *chars: F.replace(without(c, *chars[1:]), F.lit(chars[0]), F.lit("")) if chars else c
    plain = F.when(end == "\n", without(F.col("content"), "\r")).when(end == "\r", without(F.col("content"), "\n")).otherwise(without(F.col("content"), "\r", "\n"))
    zero = F.lit(0).cast("long")
    whole = files.where(F.col("content").startswith("ISA") & (F.length("content") > 105)).select("file", element.alias("sep"), end.alias("end"), plain.alias("text"))
    return whole.select("file", zero.alias("block"), zero.alias("pos"), "sep", _cut(F.col("text"), F.col("end")).alias("parts"))


def _cut(text: Column, end: Column) -> Column:
    """Trimmed parts of a text; few texts have blanks beside a terminator, and trimming costs more than looking for them."""
    parts = F.split(text, _literal(end))
    blanks = F.contains(text, F.concat(F.lit(" "), end)) | F.contains(text, F.concat(end, F.lit(" "))) | text.startswith(" ") | text.endswith(" ")
    return F.when(blanks, F.transform(parts, lambda x: F.trim(x))).otherwise(parts)


def segments(files: DataFrame) -> DataFrame:
    """Segments of X12 files (file, content), or of runs of them: file, block, pos, tag and elements e (from 0)."""
    split = "parts" in files.columns
    runs = files if split else _runs(files)
    # Separators and parts come first: what is derived beside an explode is derived after it, from a copy of the text in
    # each row. An outer one, as for others Spark filters by the parts' number, for which it makes them again.
    whole = runs.select("file", "block", F.col("pos").alias("run"), _literal(F.col("sep")).alias("sep"), "parts")
    rows = whole.select("file", "block", "run", "sep", F.posexplode_outer("parts").alias("i", "raw"))
    out = rows.where("raw <> ''").select("file", "block", (F.struct("run", "i") if split else F.col("i")).alias("pos"), F.split("raw", F.col("sep")).alias("e"))
    return out.withColumn("tag", F.get("e", F.lit(0)))


def _literal(c: Column) -> Column:
    """A pattern that matches one character; for all but letters and digits one that Java splits at without a regex."""
    return F.when(c.rlike("^[^0-9A-Za-z]$"), F.concat(F.lit("\\"), c)).otherwise(F.concat(F.lit("\\Q"), c, F.lit("\\E")))


def split_segments(spark: SparkSession, path: str, terminator: str = "~", begin: str = "CLM") -> DataFrame:
    """The same of files that Spark reads in splits, for :func:`segments` and the parsers: rows (file, block, pos, sep,
    parts) of runs of segments. A run is of the split in which it begins, with a file's first segment or a ``begin``.

    Spark cuts the text before each ``begin`` as the first file writes it (its separator, its line breaks behind
    terminators); a file that has others is right too, but one run. Of files whose header ends with another terminator
    nothing comes; :func:`odd_terminators` has their names, for :func:`segments`.
    """
    breaks, usual = _habits(spark, path, terminator)
    between = terminator + breaks + begin + usual
    raw = _split_text(spark, path, between)
    head = (F.col("block") == 0) & F.col("raw").startswith("ISA") & (F.length(F.substring_index("raw", terminator, 1)) == 105)
    where = scratch(spark, "runs")
    raw.withColumn("sep", F.when(head, F.substring("raw", 4, 1))).write.option("compression", "zstd").parquet(where)
    runs = spark.read.parquet(where)
    heads = runs.where("block = 0").groupBy("file").agg(F.min("pos").alias("first"), F.min_by("sep", "pos").alias("sep")).where("sep is not null")
    n, others = heads.agg(F.count("*"), F.count_if(F.col("sep") != usual)).first()
    # One row a file: up to so many go to every task, so that no text is shuffled.
    text = F.when((F.col("block") == 0) & (F.col("pos") == F.col("first")), F.col("raw")).otherwise(F.concat(F.lit(begin + usual), "raw"))
    known = runs.select("file", "block", "pos", "raw", "_metadata").join(F.broadcast(heads) if n <= BROADCAST_ROWS else heads, "file").withColumn("text", text)  # _metadata: of the written runs
    known = known.withColumn("text", F.replace(F.replace("text", F.lit("\r"), F.lit("")), F.lit("\n"), F.lit("")))
    parts = _cut(F.col("text"), F.lit(terminator)).alias("parts")
    kept = ["file", "block", "pos", "sep", parts, "_metadata"]
    if not others:
        return known.select(*kept)
    # What looks like a ``begin`` under another separator is none: such a file is put together again.
    pieces = F.array_sort(F.collect_list(F.struct("block", "pos", "text")))
    whole = known.where(F.col("sep") != usual).groupBy("file").agg(F.min("block").alias("block"), F.min("pos").alias("pos"), F.min("sep").alias("sep"), F.array_join(F.transform(pieces, lambda x: x["text"]), terminator + breaks).alias("text"), F.first("_metadata").alias("_metadata"))
    return known.where(F.col("sep") == usual).select(*kept).unionByName(whole.select(*kept))


def _habits(spark: SparkSession, path: str, terminator: str) -> tuple[str, str]:
    """Line breaks behind the first segment, and the separator, of a file under the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    for at in fs.globStatus(where) or []:
        each = fs.listFiles(at.getPath(), True)
        while each.hasNext():
            name = each.next().getPath()
            if name.getName()[0] not in "._":
                rows = [r[0] for r in spark.read.option("lineSep", terminator).text(name.toString()).head(2)]
                if len(rows) == 2 and rows[0].startswith("ISA"):
                    return re.match(r"[\r\n]*", rows[1])[0], rows[0][3:4]
                return "", "*"
    return "", "*"


def odd_terminators(spark: SparkSession, path: str, terminator: str = "~") -> DataFrame:
    """Files that :func:`split_segments` leaves out."""
    raw = _split_text(spark, path, terminator)
    return raw.groupBy("file").agg(F.max((F.col("block") == 0) & F.col("raw").startswith("ISA") & (F.length("raw") == 105)).alias("ok")).where("not ok").select("file")


def _split_text(spark: SparkSession, path: str, terminator: str) -> DataFrame:
    rows = spark.read.option("lineSep", terminator).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("raw"))


def carried(seg: DataFrame, starts: Column, values: dict[str, Column], in_splits: bool = True, until: int = 0) -> DataFrame:
    """``seg`` (file, block, pos) with ``seq``, how many rows that ``starts`` were there so far, and the last of each of
    ``values`` that isn't null, both over the file up to the row; the values to the row before it with ``until`` -1.

    A segmented prefix scan: windows see one split (block) at a time; one row a split goes through the second. Of
    files that aren't split (not ``in_splits``) the first is all.
    """
    names = list(values)
    rows = seg.withColumns({n: v for n, v in values.items()} | {"seq": starts.cast("int")})
    inside = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({n: F.last(n, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, until)) for n in names} | {"seq": F.sum("seq").over(inside)})
    if not in_splits:
        return local
    each = rows.groupBy("file", "block").agg(F.sum("seq").alias("seq"), *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("pos"))).alias(n) for n in names])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    into = each.select("file", "block", F.coalesce(F.sum("seq").over(before), F.lit(0)).alias("_seq"), *[F.last(n, ignorenulls=True).over(before).alias(f"_{n}") for n in names])
    out = local.join(into, ["file", "block"])
    return out.withColumns({n: F.coalesce(n, f"_{n}") for n in names} | {"seq": F.col("seq") + F.col("_seq")}).drop("_seq", *[f"_{n}" for n in names])


def rejected(files: DataFrame) -> DataFrame:
    """Files that are not X12."""
    return files.where(~(F.col("content").startswith("ISA") & (F.length("content") > 105)))


def _el(i: int) -> Column:
    return F.get("e", F.lit(i))


def _part(c: Column, i: int) -> Column:
    return F.nullif(F.get(F.split(F.coalesce(c, F.lit("")), ":"), F.lit(i)), F.lit(""))


def _claim_pieces(runs: DataFrame) -> DataFrame:
    """Runs cut before each CLM: file, block, pos, new (begins with a CLM), sep, cut (the pattern of sep) and the texts
    of the segments. A run that isn't its file's first begins with a CLM, so a claim is one piece."""
    sep = F.col("sep")
    found = runs.select("file", "block", "pos", "sep", "parts", F.array_compact(F.transform("parts", lambda x, i: F.when(_is(x, "CLM", sep), i))).alias("at"))
    bounds = F.arrays_zip(F.concat(F.array(F.lit(0)), "at").alias("a"), F.concat("at", F.array(F.size("parts"))).alias("b"))
    pieces = found.select("file", "block", "pos", "sep", F.transform(bounds, lambda x: F.slice("parts", x["a"] + 1, x["b"] - x["a"])).alias("pieces"))
    rows = pieces.select("file", "block", "pos", "sep", F.posexplode_outer("pieces").alias("k", "segs")).where("k > 0 or size(segs) > 0")
    return rows.select("file", "block", F.struct("pos", "k").alias("pos"), (F.col("k") > 0).alias("new"), "sep", _literal(sep).alias("cut"), "segs")


def _is(x: Column, tag: str, sep: Column) -> Column:
    return x.startswith(tag) & ((x == tag) | (F.substring(x, len(tag) + 1, 1) == sep))


def claims_837(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claims, lines) of 837 files (file, content), or of runs of their segments."""
    return claim_heads(files), service_lines(files)


def _tagged(*tags: str) -> Column:
    return F.filter("segs", lambda x: reduce(lambda a, b: a | b, [_is(x, t, F.col("sep")) for t in tags]))


def claim_heads(files: DataFrame) -> DataFrame:
    """Claims of 837 files, or of runs of their segments.

    A claim takes the last billing provider, subscriber and payer named before it; the service date and
    the diagnoses of its own segments.
    """
    split = "parts" in files.columns
    pieces = _claim_pieces(files if split else _runs(files))
    cut, new = F.col("cut"), F.col("new")
    elements = lambda tag: F.transform(_tagged(tag), lambda x: F.split(x, cut))
    # Texts go through the shuffle as they are, and are cut into codes and amounts behind it.
    clm = F.when(new, F.split(F.get("segs", F.lit(0)), cut)).alias("clm")
    cells = pieces.select("file", "block", "pos", "new", "cut", clm, elements("NM1").alias("nm1"), elements("DTP").alias("dtp"), elements("ST").alias("st"), _tagged("HI").alias("hi"))
    last = lambda arr, value: F.try_element_at(F.filter(F.transform(arr, value), lambda v: v.isNotNull()), F.lit(-1))
    named = lambda code: last("nm1", lambda e: F.when(F.get(e, F.lit(1)) == code, F.get(e, F.lit(9))))
    kinds = F.transform("st", lambda e: F.when(F.contains(F.coalesce(F.get(e, F.lit(3)), F.lit("")), F.lit("005010X223")), "837I").otherwise("837P"))
    day = F.array_max(F.transform("dtp", lambda e: F.when(F.get(e, F.lit(1)) == "472", F.get(e, F.lit(3)))))
    of = lambda i: F.get("clm", F.lit(i))
    short = cells.select(
        "file", "block", "pos", "new", "cut", of(1).alias("claim_id"), of(2).alias("billed"), of(5).alias("facility"), day.alias("date_of_service"), "hi",
        named("85").alias("npi"), named("IL").alias("member"), named("PR").alias("payer"), F.try_element_at(kinds, F.lit(-1)).alias("kind"), F.array_max(kinds).alias("own_kind"),
    )
    if split:  # they are read twice
        where = scratch(files.sparkSession, "claims")
        short.write.option("compression", "zstd").parquet(where)
        short = files.sparkSession.read.schema(short.schema).parquet(where)
    head = carried(short, new, {n: F.col(n) for n in ("npi", "member", "payer", "kind")}, split, until=-1).where(new)
    # Of elements with a colon what lies between it and the next.
    code = F.concat(cut, F.lit("[^"), cut, F.lit(":]*:([^"), cut, F.lit(":]*)"))
    codes = F.when(cut == "\\:", F.array().cast("array<string>")).otherwise(F.flatten(F.transform("hi", lambda x: F.regexp_extract_all(x, code, F.lit(1)))))
    return head.select(
        "file", F.col("seq").alias("claim_seq"), "claim_id", money(F.try_to_number("billed", F.lit("999999999999.99"))).alias("total_billed"), "date_of_service", F.col("npi").alias("provider_npi"),
        F.col("member").alias("patient_id"), F.col("payer").alias("payer_id"), F.greatest("kind", "own_kind").alias("transaction_type"), codes.alias("diagnosis_codes"),
        F.coalesce(_part(F.col("facility"), 2), F.lit("1")).alias("frequency_code"), _part(F.col("facility"), 0).alias("facility_type"),
    )


def service_lines(files: DataFrame) -> DataFrame:
    """Service lines of 837 files, or of runs of their segments, with their claim."""
    split = "parts" in files.columns
    pieces = _claim_pieces(files if split else _runs(files))
    cut, new = F.col("cut"), F.col("new")
    served = pieces.select("file", "block", "pos", "new", "cut", F.get(F.split(F.get("segs", F.lit(0)), cut), F.lit(1)).alias("claim_id"), _tagged("SV1", "SV2").alias("sv"))
    placed = carried(served, new, {}, split).where(new)
    each = placed.select("file", "seq", "claim_id", "cut", F.posexplode_outer("sv").alias("i", "raw")).where("raw is not null").withColumn("e", F.split("raw", cut))
    second = _el(0) == "SV2"
    service = F.when(second, _el(2)).otherwise(_el(1))
    amount = F.when(second, _el(3)).otherwise(_el(2))
    units = F.when(second, _el(5)).otherwise(_el(4))
    return each.select(
        "file",
        F.col("seq").alias("claim_seq"),
        (F.col("i") + 1).alias("line_number"),
        _part(service, 1).alias("cpt_code"),
        F.coalesce(_part(service, 2), F.lit("")).alias("modifier"),
        money(F.try_to_number(amount, F.lit("999999999999.99"))).alias("billed_amount"),
        F.coalesce(units.try_cast("double").cast("int"), F.lit(1)).alias("units"),
        "claim_id",
    )


def remittances_835(files: DataFrame) -> DataFrame:
    """One row a CLP of 835 files (or of their segments), with its adjustments, service lines and denial code."""
    number = lambda c: money(F.try_to_number(c, F.lit("S999999999999.99")))
    given = {
        "trace": F.when(F.col("tag") == "TRN", _el(2)),
        "payer": F.when((F.col("tag") == "N1") & (_el(1) == "PR"), F.coalesce(F.nullif(_el(4), F.lit("")), _el(2))),
        "era": F.when((F.col("tag") == "DTM") & (_el(1) == "405"), _el(2)),
    }
    seg = carried(segments(files), F.col("tag") == "CLP", given, "parts" in files.columns)
    inside = seg.where("seq > 0")
    clp, cas, svc = F.col("tag") == "CLP", F.col("tag") == "CAS", F.col("tag") == "SVC"
    at = F.when(F.size("e") > 2, F.sequence(F.lit(2), F.greatest(F.size("e") - 1, F.lit(2)), F.lit(3))).otherwise(F.array().cast("array<int>"))
    triplets = F.filter(F.transform(at, lambda i: F.struct(_el(1).alias("group_code"), F.get("e", i).alias("reason_code"), number(F.get("e", i + 1)).alias("amount"))), lambda a: F.coalesce(a["reason_code"], F.lit("")) != "")
    listed = lambda cond, value, name: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("block", "pos", value.alias("v"))))), lambda x: x["v"]).alias(name)
    line = F.struct(_part(_el(1), 1).alias("cpt_code"), number(_el(2)).alias("billed_amount"), number(_el(3)).alias("paid_amount"))
    from ..operators.ingest import denial_code

    out = inside.groupBy("file", "seq").agg(
        F.max(F.when(clp, _el(1))).alias("payer_claim_id"),
        F.max(F.when(clp, _el(2))).alias("claim_status"),
        F.max(F.when(clp, number(_el(3)))).alias("billed_amount"),
        F.max(F.when(clp, number(_el(4)))).alias("paid_amount"),
        F.max(F.when(clp, number(_el(5)))).alias("patient_responsibility"),
        F.max(F.when(clp, F.col("trace"))).alias("trace_number"),
        F.max(F.when(clp, F.col("payer"))).alias("payer_id"),
        F.max("era").alias("era_date"),
        F.flatten(listed(cas, triplets, "x")).alias("adjustments"),
        listed(svc, line, "service_lines"),
    )
    return out.withColumn("denial_code", denial_code())


def patients_fhir(resources: DataFrame) -> DataFrame:
    """Patients of FHIR resources (schemas.FHIR_PATIENT)."""
    first = lambda arr, cond: F.coalesce(F.get(F.filter(arr, cond), F.lit(0)), F.get(arr, F.lit(0)))
    name = first(F.col("name"), lambda n: n["use"] == "official")
    home = first(F.col("address"), lambda a: a["use"] == "home")
    mr = F.get(F.filter("identifier", lambda i: F.exists(i["type"]["coding"], lambda c: c["code"] == "MR")), F.lit(0))["value"]
    policy = F.try_element_at(F.filter("extension", lambda x: F.contains(x["url"], F.lit("insurance"))), F.lit(-1))["valueString"]
    return resources.where("resourceType = 'Patient'").select(
        F.coalesce(mr, F.col("id")).alias("patient_id"),
        F.coalesce(F.array_join(name["given"], " "), F.lit("")).alias("first_name"),
        F.coalesce(name["family"], F.lit("")).alias("last_name"),
        F.col("birthDate").try_cast("date").alias("dob"),
        F.coalesce("gender", F.lit("unknown")).alias("gender"),
        F.coalesce(F.array_join(home["line"], " "), F.lit("")).alias("address_line"),
        home["city"].alias("city"),
        home["state"].alias("state"),
        home["postalCode"].alias("zip"),
        policy.alias("insurance_id"),
        F.lit("fhir").alias("source_system"),
    )


def hl7_messages(files: DataFrame) -> DataFrame:
    """Single messages of multi-message files."""
    text = F.regexp_replace(F.regexp_replace("content", "\r\n", "\n"), "\r", "\n")
    return files.select("file", F.posexplode(F.split(text, r"(?m)(?=^MSH)")).alias("message_no", "message")).where("trim(message) <> ''")


def patients_hl7(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P5: (patients, messages that can't be parsed) of HL7 v2 ADT messages."""
    lines = F.split("message", "\n")
    line = lambda tag: F.get(F.filter(lines, lambda x: x.startswith(tag + "|")), F.lit(0))
    field = lambda tag, i: F.coalesce(F.get(F.split(line(tag), r"\|"), F.lit(i)), F.lit(""))
    comp = lambda c, i: F.coalesce(F.get(F.split(c, r"\^"), F.lit(i)), F.lit(""))
    good = F.coalesce(line("MSH").isNotNull() & line("PID").isNotNull() & F.contains(field("MSH", 8), F.lit("ADT")), F.lit(False))
    sex = F.create_map(*[F.lit(x) for kv in {"M": "male", "F": "female", "O": "other", "U": "unknown"}.items() for x in kv])
    born, name, home = field("PID", 7), field("PID", 5), field("PID", 11)
    patients = messages.where(good).select(
        comp(field("PID", 3), 0).alias("patient_id"),
        F.trim(F.concat_ws(" ", comp(name, 1), F.nullif(comp(name, 2), F.lit("")))).alias("first_name"),
        comp(name, 0).alias("last_name"),
        F.when(F.length(born) >= 8, F.try_to_timestamp(F.substring(born, 1, 8), F.lit("yyyyMMdd")).cast("date")).alias("dob"),
        F.coalesce(F.try_element_at(sex, F.upper(field("PID", 8))), F.lit("unknown")).alias("gender"),
        comp(home, 0).alias("address_line"),
        comp(home, 2).alias("city"),
        comp(home, 3).alias("state"),
        comp(home, 4).alias("zip"),
        comp(field("IN1", 2), 0).alias("insurance_id"),
        F.lit("hl7v2").alias("source_system"),
    )
    return patients, messages.where(~good)


# Names under which each canonical field of an extracted EOB may come, best first.
EOB_FIELDS = {
    "claim_number": ["ClaimNumber", "Claim_No", "ClaimID", "claim_number"],
    "paid_amount": ["PaidAmount", "PaymentAmount", "AmountPaid", "paid_amount"],
    "allowed_amount": ["AllowedAmount", "Allowed", "allowed_amount"],
    "patient_responsibility": ["PatientResp", "PatientAmount", "patient_resp"],
    "check_number": ["CheckNumber", "Check_No", "EFTNumber", "check_number"],
    "service_date": ["ServiceDate", "DOS", "DateOfService", "service_date"],
    "adjustment_reason": ["AdjustmentReason", "RemarkCode", "DenialReason"],
}


def eob_fields(eobs: DataFrame) -> DataFrame:
    """Canonical fields of extracted EOBs with their confidence, and the content's digest."""
    found = lambda names: F.coalesce(*[F.when(F.try_element_at("fields", F.lit(n))["value"].isNotNull(), F.try_element_at("fields", F.lit(n))) for n in names])
    columns = {}
    for name, names in EOB_FIELDS.items():
        columns[name] = found(names)["value"]
        columns[f"{name}_confidence"] = F.coalesce(found(names)["confidence"], F.lit(0.0))
    return eobs.withColumns(columns).withColumn("content_hash", F.sha2(F.coalesce(F.to_json("fields"), F.col("source_file")), 256))


def contract_rates(contracts: DataFrame) -> DataFrame:
    """Cells of the rate tables of extracted contracts, header rows aside, always for review."""
    rows = contracts.select("source_file", "payer_id", "provider_npi", "effective_date", F.posexplode("tables").alias("table_no", "t")).select("source_file", "payer_id", "provider_npi", "effective_date", "table_no", F.posexplode("t").alias("row_no", "r")).where("row_no > 0")
    code, rate = F.try_element_at("r", F.lit("col_0")), F.regexp_replace(F.try_element_at("r", F.lit("col_1")), "[$,]", "")
    return rows.select("source_file", "payer_id", "provider_npi", "effective_date", "table_no", "row_no", code.alias("cpt_code"), rate.try_cast("decimal(18,2)").alias("rate"), F.lit("needs_review").alias("status"))


# Fixed value: lines that begin a section of a regulation.
_HEADER = r"^(Section|§|PART|SUBPART|Article)\s+[\d.]+[A-Za-z]*\.?\s*.*$"


def chunks(docs: DataFrame, overlap: int = 200) -> DataFrame:
    """Sections of regulation texts (file, content, cfr_citation, document_title and more) with the last
    words of the section before. Text before the first header is a section of its own; empty ones are
    skipped but counted; a text without headers is one section."""
    keep = [c for c in docs.columns if c != "content"]
    order = Window.partitionBy("file").orderBy("pos")
    lines = docs.select(*keep, F.posexplode(F.split("content", "\n")).alias("pos", "line"))
    lines = lines.withColumn("is_header", F.trim("line").rlike(_HEADER)).withColumn("section", F.sum(F.col("is_header").cast("int")).over(order))
    body = lines.groupBy(*keep, "section").agg(
        F.max(F.when(F.col("is_header"), F.trim("line"))).alias("header"),
        F.regexp_replace(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n"), r"^\s+|\s+$", "").alias("text"),
    )
    each = Window.partitionBy("file")
    headed = F.max("header").over(each).isNotNull()
    first = F.min("section").over(each)
    title = F.when(~headed, "Full Document").when(F.col("header").isNull(), "Preamble").otherwise(F.col("header"))
    out = body.withColumns({"section_title": title, "section_index": F.col("section") - first}).where("text <> ''")
    before = F.split(F.lag("text").over(Window.partitionBy("file").orderBy("section")), r"\s+")
    tail = F.when(before.isNotNull(), F.array_join(F.slice(before, -F.least(F.size(before), F.lit(overlap)), F.least(F.size(before), F.lit(overlap))), " "))
    return out.select(*keep, "section_title", "section_index", F.concat_ws("\n\n", tail, "text").alias("chunk_text"), F.substring(F.sha2(F.concat_ws(":", "cfr_citation", "section_title", F.col("section_index").cast("string")), 256), 1, 16).alias("chunk_id"))


# Words in a file's name, in order, with document type and confidence.
DOCUMENT_TYPES = [
    (["eob"], "EOB", 0.95),
    (["clinical", "medical"], "clinical_record", 0.92),
    (["contract"], "contract", 0.91),
    (["denial", "correspondence"], "payer_correspondence", 0.88),
    (["appeal"], "appeal", 0.90),
    (["decision", "award"], "arbitration_decision", 0.93),
    (["auth"], "prior_auth", 0.87),
]


def classify(docs: DataFrame, name: str = "filename") -> DataFrame:
    """P10: type and confidence by file name; under 0.9 a person looks."""
    low = F.lower(name)
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
    kind, sure = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(0.0))
    for words, label, confidence in DOCUMENT_TYPES:
        kind, sure = kind.when(has(words), label), sure.when(has(words), confidence)
    out = docs.withColumn("document_type", kind.otherwise("provider_correspondence")).withColumn("confidence", sure.otherwise(0.60))
    return out.withColumn("needs_review", F.col("confidence") < 0.9)


def content_hash(docs: DataFrame, content: str = "content") -> DataFrame:
    """Digest of the content, of the name where it has none."""
    return docs.withColumn("content_hash", F.sha2(F.when(blank(content), F.col("file")).otherwise(F.col(content)), 256))
