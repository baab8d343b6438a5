"""Search of chunks for keywords by an index of trigrams, so that a keyword reads what may hold it, not all texts."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ingest import search_chunks
from .table import VersionedTable

#: Folders of postings, by the hash of the trigram.
PARTS = 64


def _trigram_list(text: str) -> list[str]:
    """Characters go by number, three of 21 bits to one, so that sorting numbers finds the distinct ones."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if len(c) < 3:
        return []
    one = np.unique(c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:])
    each = np.stack([one >> np.uint64(42), one >> np.uint64(21) & np.uint64(0x1FFFFF), one & np.uint64(0x1FFFFF)], axis=1)
    flat = each.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [flat[i : i + 3] for i in range(0, len(flat), 3)]


def trigrams(text: Column) -> Column:
    """All distinct runs of three characters in lower case; none of a shorter text."""

    @F.pandas_udf("array<string>")
    def grams(texts: pd.Series) -> pd.Series:
        return texts.map(_trigram_list, na_action="ignore")

    return grams(F.lower(text))


class ChunkIndex:
    """Chunks in buckets by chunk_id, and postings (trigram, chunk_id) in folders by trigram.

    A chunk holds a keyword only if it holds all of its trigrams. Candidates come from the postings of those
    alone, and are verified on their texts, of which only buckets with candidates are read. A keyword of one or
    two characters has no trigram: then all chunks are candidates. A chunk that comes again replaces the old
    one; its old postings only make it a candidate.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16) -> None:
        self.spark, self.buckets = spark, buckets
        self.chunks, self.postings = (VersionedTable(spark, f"{path}/{name}") for name in ("chunks", "postings"))

    def add(self, chunks: DataFrame) -> None:
        """Postings first: a chunk that is there can always be found."""
        grams = chunks.select("chunk_id", F.explode(trigrams(F.col("chunk_text"))).alias("gram"))
        self.postings.append(grams.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(PARTS)).cast("int")).repartition("part"), "part")
        self.chunks.upsert(chunks, ["chunk_id"], buckets=self.buckets)

    def candidates(self, keywords: list[str]) -> DataFrame | None:
        """chunk_id of those that hold all trigrams of any keyword; None if a keyword has none."""
        if any(len(k) < 3 for k in keywords):
            return None
        asked = self.spark.createDataFrame([(i, k) for i, k in enumerate(keywords)], "keyword int, word string")
        grams = asked.select("keyword", F.explode(trigrams(F.col("word"))).alias("gram"))
        need = {r["keyword"]: r["n"] for r in grams.groupBy("keyword").agg(F.count("*").alias("n")).collect()}
        parts = sorted(r[0] for r in grams.select(F.pmod(F.xxhash64("gram"), F.lit(PARTS)).cast("int").alias("p")).distinct().collect())
        met = self.postings.read().where(F.col("part").isin(parts)).join(F.broadcast(grams), "gram")
        full = reduce(lambda a, b: a | b, [(F.col("keyword") == k) & (F.col("n") == n) for k, n in need.items()])
        return met.groupBy("keyword", "chunk_id").agg(F.countDistinct("gram").alias("n")).where(full).select("chunk_id").distinct()

    def search(self, keywords: list[str], jurisdiction: str | None = None, on: str | None = None, k: int = 10) -> DataFrame:
        """The same rows as :func:`ingest.search_chunks` over all chunks."""
        ids = self.candidates(keywords)
        rows = self.chunks.read() if ids is None else self.chunks.read_of(ids).join(ids, "chunk_id", "left_semi")
        return search_chunks(rows, keywords, jurisdiction, on, k)
