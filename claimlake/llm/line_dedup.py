"""Removal of lines that are spread over many sites.

Each line (without blanks at its ends; empty ones aside) is known by its 128-bit digest. One
aggregation by digest merges HyperLogLog sketches of the sites, and keeps the first place of the line
by doc_id and line number. Lines whose estimate is well over MIN_SITES are boilerplate, those well
under it are not; those within BAND of it are counted exactly, over distinct pairs of digest and site.
Boilerplate goes everywhere but in its first place, so nothing is lost from the corpus altogether.

Every aggregation combines within the tasks first, so a line that a third of all rows hold is one row a
task in the shuffle. Lists of boilerplate up to BROADCAST_ROWS lines go to every task; a longer one is
joined with each digest dealt over SALTS tasks, so a hot line is no hot task. Only digests are shuffled
until, at the end, each text meets the numbers of the lines that it loses; these are broadcast if they are few.

Defined results: a null text stays null and has no lines; an empty one has one empty line. A null
source is the site "". A row is known by doc_id and text: of rows that share a doc_id each loses its own
lines, and rows equal in both are treated alike: if a line is kept in one of them, it is in the others. A
null doc_id comes before all others. Columns beside those used pass through. The same holds for empty
tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialise, packed, read_documents, unpacked

#: Lines of a list that is broadcast at most (a few tens of MB).
BROADCAST_ROWS, SALTS = 500_000, 16
#: Numbers of lines to drop that are broadcast at most, beside as many texts as above.
BROADCAST_LINES = 4_000_000
MIN_SITES, LOG_K, BAND = 10, 12, 0.2


def _row_hash(text: Column) -> Column:
    return F.xxhash64(text)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, site, line number and digest of each line that isn't blank."""
    each = docs.where(F.col("text").isNotNull()).select("doc_id", _row_hash(F.col("text")).alias("row"), F.coalesce("source", F.lit("")).alias("site"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return each.select("doc_id", "row", "site", "at", F.trim("line").alias("line")).where("line <> ''").select("doc_id", "row", "site", "at", F.unhex(F.md5("line")).alias("digest"))


def _meet(each: DataFrame, listed: DataFrame) -> DataFrame:
    """Inner join of lines with a list of distinct digests."""
    if listed.count() <= BROADCAST_ROWS:
        return each.join(F.broadcast(listed), "digest")
    salted = each.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "row"), F.lit(SALTS)))
    return salted.join(listed.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["digest", "_salt"]).drop("_salt")


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """digest and first place (doc_id, row, at) of the lines that at least ``min_sites`` sites have."""
    each = lines(docs)
    spread = each.groupBy("digest").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites"), F.min(F.struct("doc_id", "row", "at")).alias("first"))
    some = materialise(spread.where(F.col("sites") >= min_sites * (1 - BAND)), "spread")
    near = some.where(F.col("sites") <= min_sites * (1 + BAND)).select("digest")
    exact = _meet(each, near).select("digest", "site").distinct().groupBy("digest").agg(F.count("*").alias("exact"))
    return some.join(exact, "digest", "left").where(F.coalesce("exact", "sites") >= min_sites).select("digest", "first")


def _cleaned(docs: DataFrame, min_sites: int) -> DataFrame:
    """_row (:func:`packed`), clean_text, n_lines and n_removed of each row."""
    rows = packed(docs, ["doc_id", "text", "source"])
    worst = materialise(boilerplate(rows, min_sites), "boilerplate")
    hits = _meet(lines(rows), worst).where(~F.struct("doc_id", "row", "at").eqNullSafe(F.col("first"))).select("doc_id", "row", "at")
    drop = materialise(hits.groupBy(F.col("doc_id").alias("_drop_doc"), F.col("row").alias("_drop_row")).agg(F.collect_set("at").alias("_drop")), "drop")
    size = drop.agg(F.count("*"), F.sum(F.size("_drop"))).first()
    if size[0] <= BROADCAST_ROWS and (size[1] or 0) <= BROADCAST_LINES:  # then no text is shuffled
        drop = F.broadcast(drop)
    text, lost = F.col("text"), F.col("_drop")
    all_lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), lost)
    rest = F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")
    return rows.join(drop, F.col("doc_id").eqNullSafe(F.col("_drop_doc")) & (_row_hash(text) == F.col("_drop_row")), "left").select(
        "_row",
        F.when(lost.isNull() | text.isNull(), text).otherwise(rest).alias("clean_text"),
        F.when(text.isNull(), 0).otherwise(F.size(all_lines)).cast("long").alias("n_lines"),
        F.when(text.isNull(), 0).otherwise(F.coalesce(F.size(lost), F.lit(0))).cast("long").alias("n_removed"),
    )


def clean(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with n_lines, n_removed and clean_text, in place of columns of these names."""
    return unpacked(_cleaned(docs, min_sites), docs.columns, **{c: F.col(c) for c in ("clean_text", "n_lines", "n_removed")})


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with clean texts; a document of which nothing is left goes."""
    out = _cleaned(docs, min_sites).where("n_removed = 0 or trim(replace(clean_text, '\n', ' ')) <> ''")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return unpacked(out, docs.columns, **{c: v for c, v in new.items() if c in docs.columns})


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text", "source")
    return clean(docs).select("doc_id", "n_lines", "n_removed", F.md5("clean_text").alias("clean_md5"), F.length("clean_text").cast("long").alias("clean_chars"))


OP1_CTE = """
l AS (SELECT doc_id, coalesce(source, '') AS site, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS raw FROM {docs} WHERE text IS NOT NULL),
w AS (SELECT trim(raw) AS line, min([doc_id, pos]) AS first_place FROM l WHERE trim(raw) <> '' GROUP BY trim(raw) HAVING count(DISTINCT site) >= 10),
k AS (SELECT l.doc_id, l.pos, l.raw, w.line IS NOT NULL AND w.first_place <> [l.doc_id, l.pos] AS gone FROM l LEFT JOIN w ON trim(l.raw) = w.line),
c AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS clean_text FROM k GROUP BY doc_id)
"""

OP1_SQL = (
    "WITH "
    + OP1_CTE.format(docs="documents")
    + """
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed, md5(c.clean_text) AS clean_md5, CAST(length(c.clean_text) AS BIGINT) AS clean_chars
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id
"""
)
