"""Validation, routing, de-duplication and matching of incoming records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blank
from ..schemas import DENIAL_CODES, ERROR_CATEGORIES


def _messages(*pairs: tuple[Column, str | Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), m if isinstance(m, Column) else F.lit(m)) for c, m in pairs]))


def with_checks(df: DataFrame, errors: Column, warnings: Column) -> DataFrame:
    return df.withColumn("errors", errors).withColumn("warnings", warnings).withColumn("is_valid", F.size("errors") == 0)


def validate_claims(df: DataFrame) -> DataFrame:
    """V1: over claim_id, date_of_service, total_billed, lines (structs with cpt_code), diagnosis_codes, provider_npi, payer_id."""
    no_lines = F.coalesce(F.size("lines"), F.lit(-1)) <= 0
    no_code = F.filter(F.transform(F.coalesce("lines", F.array().cast(df.schema["lines"].dataType)), lambda x, i: F.when(F.coalesce(x["cpt_code"], F.lit("")) == "", F.concat(F.lit("Line "), i.cast("string"), F.lit(": missing cpt_code")))), lambda m: m.isNotNull())
    bad_total = F.col("total_billed").isNull() | (F.col("total_billed") <= 0)
    errors = F.concat(_messages((blank("claim_id"), "Missing claim_id"), (F.col("date_of_service").isNull(), "Missing date_of_service"), (bad_total, F.concat(F.lit("Invalid total_billed: "), F.coalesce(F.col("total_billed").cast("string"), F.lit("None")))), (no_lines, "No service lines")), no_code)
    warnings = _messages((F.coalesce(F.size("diagnosis_codes"), F.lit(-1)) <= 0, "No diagnosis codes"), (blank("provider_npi"), "Missing provider NPI"), (blank("payer_id"), "Missing payer_id"))
    return with_checks(df, errors, warnings)


def validate_remittances(df: DataFrame) -> DataFrame:
    """V2."""
    errors = _messages((blank("trace_number"), "Missing trace_number"), (F.col("paid_amount").isNull(), "Missing paid_amount"), (blank("payer_claim_id"), "Missing payer_claim_id"))
    return with_checks(df, errors, _messages((F.coalesce(F.size("adjustments"), F.lit(-1)) <= 0, "No adjustment reason codes")))


def validate_patients(df: DataFrame) -> DataFrame:
    """V3."""
    errors = _messages((blank("patient_id"), "Missing patient_id"), (F.col("dob").isNull(), "Missing dob"))
    return with_checks(df, errors, _messages((blank("last_name"), "Missing last_name"), (blank("insurance_id"), "Missing insurance_id")))


def validate_fees(df: DataFrame) -> DataFrame:
    """V4."""
    errors = _messages(
        (blank("cpt_code"), "Missing cpt_code"),
        (blank("geo_region"), "Missing geo_region"),
        (F.col("rate").isNull() | (F.col("rate") < 0), F.concat(F.lit("Invalid rate: "), F.coalesce(F.col("rate").cast("string"), F.lit("None")))),
        (F.col("effective_date").isNull(), "Missing effective_date"),
        (blank("rate_type"), "Missing rate_type"),
    )
    return with_checks(df, errors, F.array().cast("array<string>"))


def validate_providers(df: DataFrame) -> DataFrame:
    """V5."""
    return with_checks(df, _messages((blank("npi"), "Missing npi")), _messages((blank("specialty_taxonomy"), "Missing specialty_taxonomy"), (blank("state"), "Missing state")))


def split_valid(checked: DataFrame, source: str, entity: str, entity_id: str, category: str = "validation_failure") -> tuple[DataFrame, DataFrame]:
    """V6: (valid rows, dead letters with all messages in one detail)."""
    return checked.where("is_valid"), dead_letters(checked.where("not is_valid"), source, entity, category, F.array_join("errors", "; "), entity_id)


def dead_letters(df: DataFrame, source: str, entity: str, category: str, detail: Column, entity_id: str) -> DataFrame:
    """K8: rows in the form of the dead-letter queue, pending."""
    if category not in ERROR_CATEGORIES:
        raise ValueError(f"unknown error category {category!r}")
    return df.select(F.lit(source).alias("source"), F.lit(entity).alias("entity_type"), F.lit(category).alias("error_category"), detail.alias("error_detail"), F.col(entity_id).cast("string").alias("entity_id"), F.to_json(F.struct(*df.columns)).alias("payload"), F.lit("pending").alias("status"))


def resolve_letters(dlq: DataFrame, resolved: DataFrame, by: str) -> DataFrame:
    """K8: letters whose entity_id is in ``resolved`` are no longer pending."""
    done = resolved.select("entity_id").distinct().withColumn("_done", F.lit(True))
    return dlq.join(done, "entity_id", "left").withColumns({"status": F.when(F.col("_done"), F.lit("resolved")).otherwise(F.col("status")), "resolved_by": F.when(F.col("_done"), F.lit(by))}).drop("_done")


def pending(dlq: DataFrame) -> DataFrame:
    return dlq.where("status = 'pending'")


def _value_order(df: DataFrame) -> Column:
    """A number that only depends on a row's values, to settle ties alike in every run."""
    return F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in df.columns])))


def claim_actions(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """What each incoming claim (claim_id, frequency_code, arrival) does: insert, update, void or skip.

    A claim that isn't known is inserted by its first record; any other follows its frequency code
    (7 replaces, 8 voids, the rest are repeats). Records of one arrival come in order of code, then of values.
    """
    known = existing.select("claim_id").distinct().withColumn("_known", F.lit(True))
    first = F.row_number().over(Window.partitionBy("claim_id").orderBy("arrival", "frequency_code", _value_order(incoming))) == 1
    code = F.col("frequency_code")
    action = F.when(F.col("_known").isNull() & first, "insert").when(code == "7", "update").when(code == "8", "void").otherwise("skip")
    return incoming.join(known, "claim_id", "left").withColumn("action", action).drop("_known")


def apply_claim_actions(claims: DataFrame, lines: DataFrame, acted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claims, lines) after the actions, taken in order of arrival. The last insert or update of a claim gives
    its values and lines, all of which replace the old ones; a void keeps both and sets the status, until a
    later update sets it again."""
    live = acted.where("action in ('insert', 'update')")
    rest = [c for c in live.columns if c != "claim_id"]
    turn = F.struct("arrival", "action", _value_order(acted))
    last = live.groupBy("claim_id").agg(F.max_by(F.struct(*rest), turn).alias("r"), F.max(F.struct("arrival", "action")).alias("_live"))
    voided = acted.where("action = 'void'").groupBy("claim_id").agg(F.max(F.struct("arrival", "action")).alias("_void"))
    kinds = dict(claims.dtypes)
    status = F.when(F.col("r.action") == "insert", "received").otherwise("corrected")
    incoming = {c: F.col(f"r.{c}") for c in live.columns if c != "claim_id"} | {"status": status}
    fresh = last.select("claim_id", *[(incoming[c] if c in incoming else F.lit(None)).cast(kinds[c]).alias(c) for c in claims.columns if c != "claim_id"])
    old = claims.join(last.select("claim_id"), "claim_id", "left_anti")
    is_void = F.col("_void").isNotNull() & (F.col("_live").isNull() | (F.col("_void") > F.col("_live")))
    merged = old.unionByName(fresh).join(voided, "claim_id", "left").join(last.select("claim_id", "_live"), "claim_id", "left").withColumn("status", F.when(is_void, "voided").otherwise(F.col("status"))).drop("_void", "_live")
    new_lines = last.select("claim_id", F.posexplode("r.lines").alias("line_number", "l")).select("claim_id", (F.col("line_number") + 1).alias("line_number"), "l.*")
    kept = lines.join(last.select("claim_id"), "claim_id", "left_anti")
    return merged, kept.unionByName(new_lines.select([F.col(c).cast(dict(lines.dtypes)[c]) if c in new_lines.columns else F.lit(None).cast(dict(lines.dtypes)[c]).alias(c) for c in lines.columns]))


def new_by_key(incoming: DataFrame, existing: DataFrame, keys: list[str], *order: str, tasks: int | None = None) -> DataFrame:
    """Incoming rows whose key isn't known; of several in a batch the first by ``order``, then by values.

    A task sorts the keys that fall to it; ``tasks`` says how many there are, in place of the session's partitions.
    """
    if tasks is not None:  # on both sides, as the anti-join moves below the first's repartition
        incoming, existing = incoming.repartition(tasks, *keys), existing.select(keys).repartition(tasks, *keys)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, _value_order(incoming)))
    return incoming.join(existing.select(keys).distinct(), keys, "left_anti").withColumn("_n", first).where("_n = 1").drop("_n")


def match_claims(remits: DataFrame, claims: DataFrame, aliases: DataFrame) -> DataFrame:
    """E5: claim of each remittance's payer_claim_id: exact, then without leading zeros and case, then by alias."""
    exact = claims.select(F.col("claim_id").alias("_exact")).distinct()
    normal = lambda c: F.upper(F.trim(c))
    loose = claims.groupBy(normal(F.col("claim_id")).alias("_norm")).agg(F.min("claim_id").alias("_loose"))
    alias = aliases.groupBy(F.col("payer_claim_id").alias("_pc"), F.col("payer_id").alias("_pp")).agg(F.min("claim_id").alias("_alias"))
    out = (
        remits.withColumn("_norm", normal(F.regexp_replace("payer_claim_id", "^0+", "")))
        .join(exact, F.col("payer_claim_id") == F.col("_exact"), "left")
        .join(loose, "_norm", "left")
        .join(alias, (F.col("payer_claim_id") == F.col("_pc")) & (F.col("payer_id") == F.col("_pp")), "left")
    )
    how = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_loose").isNotNull(), "normalised").when(F.col("_alias").isNotNull(), "alias")
    return out.withColumn("claim_id", F.coalesce("_exact", "_loose", "_alias")).withColumn("matched_by", how).drop("_norm", "_exact", "_loose", "_pc", "_pp", "_alias")


def route_unmatched(matched: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(matched rows, dead letters)."""
    lost = matched.where("claim_id is null")
    return matched.where("claim_id is not null"), dead_letters(lost, source, "remittance", "unmatched_reference", F.concat(F.lit("No claim for "), F.coalesce("payer_claim_id", F.lit(""))), "payer_claim_id")


def backfill_dedup(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Each row with ``outcome``: duplicate (all four attributes equal, null equals null), conflict
    (the claim_id is known with others) or new."""
    same = ["claim_id", "date_of_service", "provider_npi", "total_billed"]
    known = existing.select(same).distinct().withColumn("_same", F.lit(True))
    ids = existing.select("claim_id").distinct().withColumn("_known", F.lit(True))
    on = None
    for c in same:
        one = F.col(f"i.{c}").eqNullSafe(F.col(f"k.{c}"))
        on = one if on is None else on & one
    out = incoming.alias("i").join(known.alias("k"), on, "left").select("i.*", "_same").join(ids, "claim_id", "left")
    return out.withColumn("outcome", F.when(F.col("_same"), F.lit("duplicate")).when(F.col("_known"), F.lit("conflict")).otherwise("new")).drop("_same", "_known")


def apply_crosswalk(claims: DataFrame, crosswalk: DataFrame, source_system: str | None = None) -> DataFrame:
    """Codes of lines and payer mapped to standard ones; ``mapping_status`` says what happened.

    Without a source system, of several mappings of a code the smallest counts. The map is looked up
    by key for every line, so claims are taken apart and put together again by claim.
    """
    rows = crosswalk if source_system is None else crosswalk.where(F.col("source_system") == source_system)
    table = rows.groupBy("legacy_code").agg(F.min("standard_code").alias("standard_code"))
    lines = claims.select("claim_id", F.posexplode_outer("lines").alias("pos", "line"))
    mapped = lines.join(table, F.col("line.cpt_code") == F.col("legacy_code"), "left").select("claim_id", "pos", F.when(F.col("line").isNotNull(), F.col("line").withField("cpt_code", F.coalesce("standard_code", "line.cpt_code"))).alias("line"), F.col("standard_code").isNotNull().alias("hit"))
    again = mapped.groupBy("claim_id").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("pos", "line")))), lambda x: x["line"]).alias("lines"), F.count_if("hit").alias("_hits"))
    payer = table.select(F.col("legacy_code").alias("_lp"), F.col("standard_code").alias("_sp"))
    out = claims.drop("lines").join(again, "claim_id").join(payer, F.col("payer_id") == F.col("_lp"), "left").withColumn("payer_id", F.coalesce("_sp", "payer_id"))
    status = F.when((F.col("_hits") > 0) | F.col("_sp").isNotNull(), "mapped").otherwise("unchanged")
    return out.withColumn("mapping_status", status).drop("_hits", "_lp", "_sp")


def ingest_backfill(incoming: DataFrame, existing: DataFrame, crosswalk: DataFrame, source_system: str | None = None) -> dict[str, DataFrame]:
    """Crosswalk, validation and de-duplication of historical claims, which raise no events."""
    checked = validate_claims(apply_crosswalk(incoming, crosswalk, source_system))
    valid, letters = split_valid(checked, "backfill", "claim", "claim_id")
    judged = backfill_dedup(valid, existing)
    fresh = judged.where("outcome = 'new'").withColumn("status", F.lit("historical")).withColumn("source", F.lit("backfill"))
    return {"new": fresh, "skipped": judged.where("outcome = 'duplicate'"), "review": judged.where("outcome = 'conflict'"), "dead_letters": letters}


def ingest_remittances(parsed: DataFrame, claims: DataFrame, aliases: DataFrame, existing: DataFrame) -> dict[str, DataFrame]:
    """Parsed 835 records to new remittances, dead letters, audit rows and events."""
    valid, invalid = split_valid(validate_remittances(parsed), "edi_835", "remittance", "payer_claim_id")
    matched, unmatched = route_unmatched(match_claims(valid, claims, aliases), "edi_835")
    fresh = new_by_key(matched, existing, ["claim_id", "trace_number", "payer_id"], "payer_claim_id")
    return {"new": fresh, "dead_letters": invalid.unionByName(unmatched), "audit": audit(fresh, "remittance", "claim_id", "insert"), "events": events(fresh, "remittance.received", "remittance", "claim_id")}


def ingest_eobs(eobs: DataFrame, claims: DataFrame, aliases: DataFrame, known: DataFrame, least: float = 0.9) -> dict[str, DataFrame]:
    """Artifacts of all new EOBs; those of good confidence that match a claim become remittances."""
    fresh = new_by_key(eobs, known, ["content_hash"], "source_file")
    sure = fresh.where(F.col("avg_confidence") >= least).withColumn("payer_claim_id", F.col("claim_number"))
    matched = match_claims(sure, claims, aliases)
    return {"artifacts": fresh, "remittances": matched.where("claim_id is not null"), "review": fresh.where(F.coalesce(F.col("avg_confidence"), F.lit(0.0)) < least), "unmatched": matched.where("claim_id is null")}


def upsert_patients(existing: DataFrame, *feeds: DataFrame) -> DataFrame:
    """The last record of each patient over all feeds in place of the stored one."""
    from functools import reduce

    from .merge import upsert

    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
    rest = [c for c in every.columns if c != "patient_id"]
    last = every.groupBy("patient_id").agg(F.max_by(F.struct(*rest), F.struct("last_updated", _value_order(every))).alias("r")).select("patient_id", "r.*")
    return upsert(existing, last, ["patient_id"])


def ingest_documents(docs: DataFrame, known: DataFrame, entity: str = "document") -> dict[str, DataFrame]:
    """New documents by content hash, and their events."""
    fresh = new_by_key(docs, known, ["content_hash"], "filename")
    return {"new": fresh, "events": events(fresh, f"{entity}.ingested", entity, "content_hash")}


def search_chunks(chunks: DataFrame, keywords: list[str], jurisdiction: str | None = None, on: str | None = None, k: int = 10) -> DataFrame:
    """Chunks that hold any keyword, in force on a date, best match first."""
    rows = chunks if jurisdiction is None else chunks.where(F.col("jurisdiction") == jurisdiction)
    if on is not None:
        day = F.lit(on).cast("date")
        rows = rows.where((F.col("effective_date") <= day) & (F.col("superseded_date").isNull() | (F.col("superseded_date") > day)))
    low = F.lower("chunk_text")
    hits = F.lit(0)
    for word in keywords:
        hits = hits + F.contains(low, F.lit(word.lower())).cast("int")
    return rows.withColumn("matches", hits).where("matches > 0").orderBy(F.desc("matches"), "chunk_id").limit(k)


def denial_code(adjustments: str = "adjustments") -> Column:
    """Reason of the first contractual adjustment that is a denial."""
    found = F.filter(F.col(adjustments), lambda a: (a["group_code"] == "CO") & a["reason_code"].isin(DENIAL_CODES))
    return F.get(found, F.lit(0))["reason_code"]


# ---- side outputs


def audit(df: DataFrame, entity: str, entity_id: str, action: str, user: str = "system", at: Column | None = None) -> DataFrame:
    """K9: one row for each decision."""
    return df.select(F.lit(entity).alias("entity_type"), F.col(entity_id).cast("string").alias("entity_id"), F.lit(action).alias("action"), F.lit(user).alias("user_id"), (at if at is not None else F.current_timestamp()).alias("timestamp"))


# Topic of each entity type.
TOPICS = {"claim": "claims", "remittance": "remittances", "document": "documents", "contract": "documents", "regulation": "documents", "case": "status-changes", "dispute": "status-changes"}


def events(df: DataFrame, event_type: str, entity: str, entity_id: str) -> DataFrame:
    """Events of rows that were not skipped, with their topic."""
    rows = df.where("action <> 'skip'") if "action" in df.columns else df
    return rows.select(F.lit(event_type).alias("event_type"), F.lit(entity).alias("entity_type"), F.col(entity_id).cast("string").alias("entity_id"), F.lit(TOPICS.get(entity, "status-changes")).alias("topic"), F.to_json(F.struct(*rows.columns)).alias("payload"))
