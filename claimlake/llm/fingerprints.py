"""MinHash fingerprints of texts, their likeness, and links between like texts by signature bands.

A text is the set of its 5-word shingles (with fewer words, of all its words as one). A fingerprint is 64
minima under universal hash functions, kept to 16 bits each, in hexadecimal. The likeness of two
fingerprints is the share of equal minima, which estimates the Jaccard similarity of the sets; two texts
without a word are alike.

Texts that share a band of four minima are joined in Spark and verified on their full sets; links that
hold make groups.

Defined results: a null text counts as empty; equal doc_ids follow each other by text; a null doc_id
comes last in descending order. The next document of the only one is itself. Further columns are
ignored. No documents: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import near_dedup
from . import shingles as S
from .store import Run, give_back, read_documents, small_batches
from .token_files import id_ranges, task_count

SYMBOLS = 64
#: Documents that go to one range of doc_ids; neighbours are found inside a range and its first follower.
PER_RANGE = 64
#: Ranges that a task has, about, once there are more than the session's shuffle partitions.
RANGES_PER_TASK = 800
#: Bands of four minima: at a Jaccard similarity of 0.75 a pair shares one of the 16 with a chance of 0.997.
BAND = 4


def _minima(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (S.mix(S.signatures(values, n, *S.permutations(SYMBOLS, seed=97))) >> np.uint64(48)).astype(np.uint16)


def fingerprint_rows(texts: pa.Array) -> np.ndarray:
    """One row of 64 16-bit minima for each text."""
    out = np.zeros((len(texts), SYMBOLS), np.uint16)
    for i, j, values, n in near_dedup.text_sets(texts):
        out[i:j] = _minima(values, n)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = fingerprint_rows(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r.astype(">u2").tobytes().hex() for r in rows])], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Documents dealt by descending doc_id: columns part, follower, doc_id, text, sorted in each partition.

    ``part`` numbers ranges of ids. After its own documents each range has, as ``follower`` = 1, the
    first document of the next range that has any (of the first one, after the last), so that every
    document's successor comes right after it. Texts are shuffled once.
    """
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = slim.count()
    at = slim.withColumn("part", -id_ranges(slim.select("doc_id"), PER_RANGE, n))
    heads = at.groupBy("part").agg(F.max("doc_id").alias("doc_id"))  # a row a range
    order = Window.orderBy("part")
    last = F.max("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = heads.select("doc_id", F.coalesce(F.lag("part").over(order), last).alias("before"))
    dealt = at.join(F.broadcast(before), "doc_id", "left")
    rows = dealt.select(
        F.explode(F.when(F.col("before").isNull(), F.array(F.struct("part", F.lit(0).alias("follower")))).otherwise(F.array(F.struct("part", F.lit(0).alias("follower")), F.struct(F.col("before").alias("part"), F.lit(1).alias("follower"))))).alias("to"),
        "doc_id",
        "text",
    ).select("to.part", "to.follower", "doc_id", "text")
    tasks = task_count(docs.sparkSession, -(-n // PER_RANGE), RANGES_PER_TASK)
    return rows.repartition(tasks, "part").sortWithinPartitions("part", "follower", F.desc("doc_id"), "text")


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The edited text has, in place of its last floor(n_chars / 2) characters, the first as many (or
    all) of the next document in descending order of doc_id; after the last comes the first.
    """
    small_batches(docs.sparkSession)

    def like(a: np.ndarray, b: np.ndarray, equal: list[bool]) -> np.ndarray:
        return np.where(equal, 1.0, (a == b).mean(axis=1) if len(a) else 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last document, which still lacks its successor
        for batch in batches:
            rows = held + list(zip(batch.column("part").to_pylist(), batch.column("follower").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True))
            held = rows[-1:]
            prints = fingerprint_rows(pa.array([r[3] for r in rows], pa.large_string()))
            at = [k for k in range(len(rows) - 1) if rows[k][1] == 0 and rows[k + 1][0] == rows[k][0]]
            texts, followers = [rows[k][3] for k in at], [rows[k + 1][3] for k in at]
            edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, followers, strict=True)]
            theirs = fingerprint_rows(pa.array(edited, pa.large_string()))
            own, following = prints[at], prints[[k + 1 for k in at]]
            hexed = lambda x: pa.array([r.astype(">u2").tobytes().hex() for r in x], pa.string())
            none = -(2**63)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if rows[k][2] == none else rows[k][2] for k in at], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                    hexed(own),
                    hexed(theirs),
                    pa.array(like(own, theirs, [a == b for a, b in zip(texts, edited, strict=True)]) if at else [], pa.float64()),
                    pa.array(like(own, following, [a == b for a, b in zip(texts, followers, strict=True)]) if at else [], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return with_next(docs).mapInArrow(run, _EDITED)


_PRINTS = "doc_id long, text_hash long, n_shingles long, set_hi long, set_lo long, fingerprint string"


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, values, n in near_dedup.text_sets(batch.column("text")):
            digests = near_dedup.set_digests(values, n)
            rows = _minima(values, n).astype(">u2")
            ids = [batch.column(c).slice(i, j - i) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(n), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([r.tobytes().hex() for r in rows])], ["doc_id", "text_hash", "n_shingles", "set_hi", "set_lo", "fingerprint"])
    give_back()


def _linked(run: Run, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prints, classes, links): texts with a shingle, classes of equal sets, and links (a, b, jaccard) of class_ids."""
    small_batches(docs.sparkSession)
    prints = run.table(near_dedup.slim_texts(docs).mapInArrow(_print_batches, _PRINTS).where("n_shingles > 0"), "prints")
    classes = near_dedup.set_classes(run, prints, "fingerprint")
    width = 4 * BAND
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("fingerprint", k * width + 1, width)) for k in range(SYMBOLS // BAND)])
    index = classes.select("class_id", "n_shingles", F.col("first.doc_id").alias("doc_id"), F.lit(SYMBOLS // BAND).alias("keys"), F.explode(bands).alias("key"))
    links = near_dedup.settle(run, index, lambda pairs: near_dedup.confirmed(run, docs, classes, pairs), lambda mixed: near_dedup._across(run, docs, classes, mixed))
    return prints, classes, links


def near_links(docs: DataFrame) -> DataFrame:
    """Links (a, b, jaccard) of texts that share a band of minima, verified on full shingle sets at 0.75 or more.

    Texts with equal sets are one class, whose members are linked with its smallest doc_id. Classes are held
    against hubs of their bands first, so a group of them makes as many rows as it has members. Bands
    that still hold several components are then settled on their full sets by prefixes. So the links connect what links of all pairs that share a band would; a link that would
    only close a circle inside a component need not be listed.
    """
    run = Run(docs.sparkSession, "near_links")
    prints, classes, links = _linked(run, docs)
    name = classes.select("class_id", F.col("first.doc_id").alias("doc_id"))
    between = links.join(name.select(F.col("class_id").alias("a"), F.col("doc_id").alias("da")), "a").join(name.select(F.col("class_id").alias("b"), F.col("doc_id").alias("db")), "b")
    inside = prints.join(classes.drop("fingerprint"), ["set_hi", "set_lo", "n_shingles"]).where(~(F.struct("doc_id", "text_hash").eqNullSafe(F.col("first"))))
    return run.result(between.select(F.least("da", "db").alias("a"), F.greatest("da", "db").alias("b"), "jaccard").unionByName(inside.select(F.col("first.doc_id").alias("a"), F.col("doc_id").alias("b"), F.lit(1.0).alias("jaccard"))))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, print_hash and near_group (smallest doc_id that links reach) of each text that has a shingle and is linked."""
    run = Run(docs.sparkSession, "near_groups")
    prints, classes, links = _linked(run, docs)
    root = near_dedup.components(links.select("a", "b"), run)
    placed = classes.drop("first", "fingerprint").join(root.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    rows = run.table(prints.select("doc_id", "set_hi", "set_lo", "n_shingles", F.xxhash64("fingerprint").alias("print_hash")).join(placed, ["set_hi", "set_lo", "n_shingles"]).select("doc_id", "print_hash", "root"), "placed")
    groups = rows.groupBy("root").agg(F.min("doc_id").alias("near_group"), F.count("*").alias("k")).where("k > 1").select("root", "near_group")
    return run.result(rows.join(groups, "root").groupBy("doc_id", "print_hash").agg(F.min("near_group").alias("near_group")))


def with_groups(docs: DataFrame) -> DataFrame:
    """:func:`edited_likeness` and near_group: the smallest doc_id that a chain of links reaches, else the own one."""
    groups = near_groups(docs).withColumnRenamed("doc_id", "_id")
    few = F.broadcast(groups) if groups.count() <= near_dedup.BROADCAST_ROWS else groups
    rows = edited_likeness(docs)
    return rows.join(few, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("fingerprint") == F.col("print_hash")), "left").select(*rows.columns, F.coalesce("near_group", "doc_id").alias("near_group"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_groups(read_documents(spark, sf_dir))
