"""Benchmark decontamination by pigeonhole edit matching.

Items and texts are normalised: lower case, each run of anything but letters and digits one blank, and one
at both ends. An item of n characters may occur with k = floor(n * ERROR_RATE) edits, the blanks at its ends
counting like other characters: where there is no edit, it must stand as whole words. Cut into k + 1
pieces, at least one piece must stand unchanged in any such occurrence, where it belongs to within k places. One automaton of all pieces of a block of items runs over each whole text; every hit gives a
window in which Myers' bit-parallel algorithm, one machine word operation a character whatever the
item's length, finds the least edit distance of the item to any stretch. Within the budget, the text
is contaminated by the item. Hits that give the same window for an item are verified once.

The items are the query set: they are held in blocks of about BLOCK_CHARS characters, each block against
all texts; no text is shuffled, and the number of blocks, not a broadcast, grows with a larger benchmark.
Distinct texts are dealt to blocks on their own, so one item_id with many of them is in many blocks.

Defined results: null or empty texts and items (also those without a letter or digit) match nothing. Of
several texts of an item_id the nearest counts; a null item_id is an item like others. Repeated documents
give equal rows. Further columns are ignored. An empty benchmark leaves every text clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import give_back, packed, read_documents, small_batches, unpacked

ERROR_RATE = 0.08
BLOCK_CHARS = 4_000_000

_OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Words with one blank between them, and one at both ends; "" without a word."""
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {words} " if words else ""


def budget(n: int, rate: float = ERROR_RATE) -> int:
    return int(n * rate)


def cut(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length and where each starts."""
    n, out = len(item), []
    for i in range(k + 1):
        a, b = i * n // (k + 1), (i + 1) * n // (k + 1)
        out.append((a, item[a:b]))
    return out


class Pattern:
    """Myers' bit vectors of one item: least edit distance to any stretch of a text."""

    def __init__(self, item: str) -> None:
        self.n = len(item)
        self.peq: dict[str, int] = {}
        for i, c in enumerate(item):
            self.peq[c] = self.peq.get(c, 0) | 1 << i
        self.full, self.top = (1 << self.n) - 1, 1 << (self.n - 1)

    def least(self, text: str, k: int) -> int:
        """The distance, or one over k if it is above k; stops when 0 is reached."""
        plus, minus, score, best = self.full, 0, self.n, self.n
        full, top, peq = self.full, self.top, self.peq
        left = len(text)
        for c in text:
            eq = peq.get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            up = minus | ~(xh | plus) & full
            down = plus & xh
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = up << 1 & full
            down = down << 1 & full
            plus = down | ~(xv | up) & full
            minus = up & xv
            left -= 1
            if score < best:
                best = score
                if not best:
                    break
            elif score - left > k and best > k:
                break
        return min(best, k + 1)


class Matcher:
    """All items of a block, ready to run over texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float) -> None:
        import ahocorasick

        self.items = [(i, t, budget(len(t) - 2, rate)) for i, t in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for number, (_, t, k) in enumerate(self.items):
            for at, piece in cut(t, k):
                where.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.patterns: dict[int, Pattern] = {}

    def matches(self, text: str) -> list[tuple[int | None, int]]:
        """(item_id, distance) of each item in the normalised text, within its budget."""
        if not self.items:
            return []
        tried: set[tuple[int, int]] = set()
        found: dict[int, int] = {}
        for end, (size, places) in self.automaton.iter(text):
            for number, at in places:
                if found.get(number) == 0:
                    continue
                _, t, k = self.items[number]
                if not k:  # its one piece is all of it
                    found[number] = 0
                    continue
                q = (end + 1 - size - at) // (k + 1)  # the item would start there, were there no edits
                if (number, q) in tried:
                    continue
                tried.add((number, q))
                pattern = self.patterns.get(number) or self.patterns.setdefault(number, Pattern(t))
                d = pattern.least(text[max(0, q * (k + 1) - k) : (q + 1) * (k + 1) + len(t) + k], k)
                if d <= k:
                    found[number] = min(d, found.get(number, d))
        best: dict[int | None, int] = {}
        for number, d in sorted(found.items()):
            item_id = self.items[number][0]
            best[item_id] = min(d, best.get(item_id, d))
        return list(best.items())


_HITS = "doc_id long, item_id long, distance long"


def item_blocks(benchmark: DataFrame, size: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The normalised items in blocks of about ``size`` characters, dealt by the hash of item_id and text."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // size)
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        items = {(r["item_id"], t) for r in part.distinct().toLocalIterator() if (t := normal(r["text"]))}
        if items:
            yield sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def hits(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, size: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and item that it holds: doc_id, item_id and the least edit distance."""
    spark = docs.sparkSession
    small_batches(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    parts = []
    for number, block in enumerate(item_blocks(benchmark, size)):
        shared = spark.sparkContext.broadcast(block)  # about BLOCK_CHARS characters

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows: list[tuple[int | None, ...]] = []
                for doc_id, h, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")], strict=True):
                    if text:
                        rows += [(doc_id, h, i, d) for i, d in matcher.matches(normal(text))]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(4)], ["doc_id", "text_hash", "item_id", "distance"])

        parts.append(slim.mapInArrow(run, "doc_id long, text_hash long, item_id long, distance long").withColumn("block", F.lit(number)))
    if not parts:
        return spark.createDataFrame([], _HITS)
    if len(parts) == 1:
        return parts[0].select("doc_id", "item_id", "distance")
    # Several texts of an item may be in different blocks: of each document as many rows as it is repeated, the nearest text's.
    once = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "text_hash", "item_id", "block").agg(F.count("*").alias("n"), F.min("distance").alias("distance"))
    best = once.groupBy("doc_id", "text_hash", "item_id").agg(F.max("n").alias("n"), F.min("distance").alias("distance"))
    return best.withColumn("copy", F.explode(F.expr("sequence(1, cast(n as int))"))).select("doc_id", "item_id", "distance")


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without those that hold an item; rows are dropped where they are read, block by block of items."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = packed(docs, ["text"])
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                yield batch.filter(pa.array([not (text and matcher.matches(normal(text))) for text in batch.column("text").to_pylist()], pa.bool_()))
            give_back()

        rows = rows.mapInArrow(run, rows.schema)
    return unpacked(rows, docs.columns)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents: doc_id, item_id and edit distance of each hit."""
    return hits(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
