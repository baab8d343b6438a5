"""Ranked search of documents for the terms of items by NRA: sorted reads only, intervals of scores.

A term's list holds what it adds to the score of each document that has it (its impact), and is read in
descending order of impact, all lists down to the same impact, round by round. What a document has shown so far
is the lower end of its score for an item; what its other terms could still add, as no list holds
more than the impact it is read down to, makes the upper end. Per item

* a document is out as soon as its upper end is below the tenth best lower end of all documents, the bar;
* once documents that weren't seen yet can't reach the bar either, no more come in;
* reads go on until nobody who is in has room between their ends, so that members, ties and scores are final.

No list is ever looked up for one document. The lists are cut by documents into shards of SHARD_DOCS: a row of
the index is a shard, with a column for each level of impact (a power of two), in which the entries of all
lists lie in descending order. A round is one job that reads the columns down to its level, adds up the ends of
a shard's documents in numpy, and returns by item the best lower ends above the bar, the most that an
unseen document could have, and how many documents are in and still open. Shards share nothing but
the bar of each item, which follows from all of them after each round. Nothing is shuffled but these few rows.

The items are the query set, taken in blocks of about BLOCK_TERMS terms, each against all documents. Terms are
known by 64-bit hashes. Statistics count all documents.

Defined results: an item is a row of the table with its item_id, which may be null or repeated (each such row has
ranks of its own); a null text, or one without a term, has none. A null text of a document has no term; rows
are documents, whatever their doc_id, and equal scores are ordered by doc_id (null last), then by row.
Terms that all documents have weigh 0. Fewer than TOP documents above 0: all of them. No items or documents: no
rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shingles as S
from .store import Run, give_back, read_documents, small_batches

TOP = 10
#: Terms of items that are looked for together (with repeats over items; about 16 bytes each in a broadcast).
BLOCK_TERMS = 1_000_000
#: Documents of a shard, and items whose ends are added up together: two arrays of 8 bytes each.
SHARD_DOCS, ITEMS_TOGETHER = 8192, 64
#: Levels of impact: entries of 2**TOP_LEVEL and more, of half as much and more, and so on; the last has all the rest.
TOP_LEVEL, LEVELS = 33, 14
#: Bytes that end a term: of ASCII all but digits and letters.
_BETWEEN = S.byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts, with the hash and text number of each occurrence of a term."""
    raw, at = S.text_bytes(batch.column("text"))
    for i, j in S.blocks(at):
        h, owner, _, _ = S.word_hashes(raw[at[i] : at[j]], at[i : j + 1] - at[i], _BETWEEN)
        yield i, j, h, owner


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, _, h, owner in _terms(batch):
            some = np.unique(np.rec.fromarrays([owner, h]))
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(some.f0 + i)), batch.column("item_id").take(pa.array(some.f0 + i)), pa.array(some.f1.astype(np.uint64).view(np.int64))], ["item", "item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number of the row), item_id and term (hash) of each distinct term of each item."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_item_batches, "item long, item_id long, term long")


def term_counts(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """doc_id, n (its terms with repeats) and, of ``wanted`` (hashes, ascending), those it has with their counts."""
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = known.value
        for batch in batches:
            for i, j, h, owner in _terms(batch):
                n = np.bincount(owner, minlength=j - i)
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                pairs, counts = np.unique(owner[hit] * max(len(keys), 1) + at[hit], return_counts=True)
                ends = pa.array(np.searchsorted(pairs, np.arange(j - i + 1) * max(len(keys), 1)).astype(np.int32))
                own = keys[pairs % len(keys)].view(np.int64) if len(pairs) else np.zeros(0, np.int64)
                listed = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (own, counts.astype(np.int64))]
                out = pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(n.astype(np.int64)), *listed], ["doc_id", "n", "terms", "counts"])
                yield out.filter(pa.array(n > 0))
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<long>, counts array<long>")


def _weights(counts: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Documents, their terms, and the terms that weigh more than 0 with their weights (BLOCK_TERMS at most)."""
    docs, all_terms = counts.agg(F.count("*"), F.sum("n")).first()
    df = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    rows = df.select("term", F.floor(1000 * F.log(F.lit(2 * docs + 2) / (2 * F.col("df") + 1))).alias("w")).where("w > 0").toArrow()
    terms = rows["term"].to_numpy().view(np.uint64)
    order = np.argsort(terms)
    return docs, all_terms or 1, terms[order], rows["w"].to_numpy()[order]


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers, one after another, their lengths first."""
    return np.concatenate([np.array([len(arrays), *map(len, arrays)], np.int64), *[a.astype(np.int64) for a in arrays]]).tobytes()


def _unpack(blob: bytes) -> list[np.ndarray]:
    x = np.frombuffer(blob, np.int64)
    ends = np.cumsum(x[1 : 1 + x[0]]) + 1 + x[0]
    return [x[e - n : e] for e, n in zip(ends.tolist(), x[1 : 1 + x[0]].tolist(), strict=True)]


_SHARD = "shard long, doc_ids binary, ends binary, " + ", ".join(f"l{i} binary" for i in range(LEVELS))


def lists(counts: DataFrame, docs: int, all_terms: int, terms: np.ndarray, weights: np.ndarray) -> DataFrame:
    """A row a shard: doc_ids; of each term its largest and smallest impact; and by level terms, ends, documents, impacts.

    A level has the entries of each of its terms one after another, in descending order of impact.
    """
    shared = counts.sparkSession.sparkContext.broadcast((terms, weights))
    none = np.iinfo(np.int64).max

    def shard(number: int, rows: list[tuple]) -> list:
        known, weight = shared.value
        ids = np.array([none if r[0] is None else r[0] for r in rows], np.int64)
        n = np.array([r[1] for r in rows], np.int64)
        size = np.array([len(r[2]) for r in rows])
        doc = np.repeat(np.arange(len(rows)), size)
        key = np.concatenate([r[2] for r in rows]).view(np.uint64)
        tf = np.concatenate([r[3] for r in rows])
        at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
        heavy = known[at] == key if len(known) else np.zeros(len(key), bool)
        doc, at, tf = doc[heavy], at[heavy], tf[heavy]
        m = 100 - 90 + (90 * n[doc] * docs) // all_terms
        impact = weight[at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        some = impact > 0
        doc, at, impact = doc[some], at[some], impact[some]
        order = np.lexsort((doc, -impact, at))
        doc, at, impact = doc[order], at[order], impact[order]
        term, first = np.unique(at, return_index=True)
        last = np.concatenate((first[1:], [len(at)]))[: len(term)]
        out = [number, ids.tobytes(), _pack(term, impact[first], impact[last - 1])]
        level = np.clip(TOP_LEVEL - np.frexp(impact.astype(np.float64))[1] + 1, 0, LEVELS - 1)
        for i in range(LEVELS):
            mine = np.flatnonzero(level == i)
            t, begin = np.unique(at[mine], return_index=True)
            out.append(_pack(t, np.concatenate((begin, [len(mine)])), doc[mine], impact[mine]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in _SHARD.split(", ")])
        held: list[tuple] = []
        part, seen = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal seen
            seen += 1
            row = shard((part << 24) + seen, held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "n")]
            arrays = []
            for c in ("terms", "counts"):
                ends, flat = batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()
                arrays.append([flat[x:y].copy() for x, y in zip(ends[:-1], ends[1:], strict=True)])
            for row in zip(*cols, *arrays, strict=True):
                held.append(row)
                if len(held) == SHARD_DOCS:
                    yield flush()
            part = batch.column("part")[0].as_py() if batch.num_rows else part
        if held:
            yield flush()
        give_back()

    return counts.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "n", "terms", "counts").mapInArrow(run, _SHARD)


class _Items:
    """Items of a block that are still open: for each term the numbers of its items."""

    def __init__(self, term: np.ndarray, item: np.ndarray, bars: np.ndarray) -> None:
        order = np.lexsort((item, term))
        term, self.item, self.bars = term[order], item[order], bars
        self.term, self.first = np.unique(term, return_index=True)
        self.last = np.concatenate((self.first[1:], [len(term)]))[: len(self.term)]

    def of(self, term: int, lo: int, hi: int) -> np.ndarray:
        """Those of the term between two numbers, counted from the lower one."""
        i = int(np.searchsorted(self.term, term))
        if i == len(self.term) or self.term[i] != term:
            return self.item[:0]
        some = self.item[self.first[i] : self.last[i]]
        return some[np.searchsorted(some, lo) : np.searchsorted(some, hi)] - lo


def _round(shards: DataFrame, items: _Items, level: int) -> DataFrame:
    """Read all lists down to ``level``: of each shard and item the best lower ends, and a row for what is open.

    Columns item, doc_id, row (null in a row for what is open), low, unseen, n_open.
    """
    shared = shards.sparkSession.sparkContext.broadcast(items)
    down_to = 0 if level == LEVELS - 1 else 1 << (TOP_LEVEL - level)
    none = np.iinfo(np.int64).max

    def ends_of(blobs: list, ids: np.ndarray, bounds: list[np.ndarray], lo: int, hi: int) -> tuple:
        """Lower ends, upper ends and the most of an unseen document, for items lo to hi."""
        asked: _Items = shared.value
        low = np.zeros((hi - lo, len(ids)), np.int64)
        own = np.zeros_like(low)
        unseen = np.zeros(hi - lo, np.int64)
        room = np.where(bounds[2] >= down_to, 0, np.minimum(bounds[1], down_to - 1))
        left = dict(zip(bounds[0].tolist(), room.tolist(), strict=True))
        who = {t: asked.of(t, lo, hi) for t in left}
        for t, r in left.items():
            unseen[who[t]] += r
        for term, begin, doc, impact in blobs:
            for i, t in enumerate(term.tolist()):
                if len(some := who[t]):
                    a, b = begin[i], begin[i + 1]
                    cells = some[:, None], doc[a:b]
                    low[cells] += impact[a:b]
                    if left[t]:
                        own[cells] += left[t]
        return low, low + unseen[:, None] - own, unseen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bars = shared.value.bars
        for batch in batches:
            for k in range(batch.num_rows):
                number = batch.column("shard")[k].as_py()
                ids = np.frombuffer(batch.column("doc_ids")[k].as_py(), np.int64)
                bounds = _unpack(batch.column("ends")[k].as_py())
                blobs = [_unpack(batch.column(f"l{i}")[k].as_py()) for i in range(level + 1)]
                out: list[tuple] = []
                for lo in range(0, len(bars), ITEMS_TOGETHER):
                    hi = min(len(bars), lo + ITEMS_TOGETHER)
                    low, high, unseen = ends_of(blobs, ids, bounds, lo, hi)
                    bar = bars[lo:hi, None]
                    n_open = ((high >= bar) & (high > low)).sum(axis=1)
                    for i in range(hi - lo):
                        good = np.flatnonzero((low[i] >= bar[i]) & (low[i] > 0))
                        if len(good) > TOP:
                            least = np.partition(low[i][good], len(good) - TOP)[len(good) - TOP]
                            good = good[low[i][good] >= least]
                        best = good[np.lexsort((good, ids[good], -low[i][good]))][:TOP]
                        out += [(lo + i, None if ids[d] == none else int(ids[d]), number * SHARD_DOCS + int(d), int(low[i, d]), None, None) for d in best.tolist()]
                        out.append((lo + i, None, None, None, int(unseen[i]), int(n_open[i])))
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(6)], ["item", "doc_id", "row", "low", "unseen", "n_open"])
        give_back()

    read = shards.select("shard", "doc_ids", "ends", *[f"l{i}" for i in range(level + 1)])
    return read.mapInArrow(run, "item long, doc_id long, row long, low long, unseen long, n_open long")


def _levels(run: Run, shards: DataFrame) -> list[int]:
    """The level that each round reads down to: one or more further ones, together at least as large as all before."""
    sizes = shards.agg(*[F.sum(F.length(f"l{i}")).alias(f"l{i}") for i in range(LEVELS)]).first()
    out, before, here = [], 0, 0
    for i in range(LEVELS):
        here += sizes[i] or 0
        if i == LEVELS - 1 or here >= max(1, 2 * before):
            out.append(i)
            before, here = before + here, 0
    return out


def _search_block(run: Run, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """item, rank, doc_id, score for the items of one block (item, term)."""
    spark = docs.sparkSession
    asked = wanted.select("item", "term").toArrow()  # BLOCK_TERMS rows, about
    item, names = np.unique(asked["item"].to_numpy(), return_inverse=True)[::-1]
    term = asked["term"].to_numpy().view(np.uint64)
    counts = run.table(term_counts(docs, np.unique(term)), "counts")
    n_docs, all_terms, heavy, weights = _weights(counts)
    shards = run.table(lists(counts, n_docs, all_terms, heavy, weights), "lists")
    run.drop(counts)
    at = np.minimum(np.searchsorted(heavy, term), max(len(heavy) - 1, 0))
    some = heavy[at] == term if len(heavy) else np.zeros(len(term), bool)
    term, item = at[some], item[some]
    open_ = np.unique(item)  # numbers of the items that aren't final
    bars = np.zeros(len(names), np.int64)
    found: list[DataFrame] = []
    order = Window.partitionBy("item").orderBy(F.desc("low"), F.asc_nulls_last("doc_id"), "row")
    for level in _levels(run, shards):
        if not len(open_):
            break
        mine = np.isin(item, open_)
        rows = run.table(_round(shards, _Items(term[mine], np.searchsorted(open_, item[mine]), bars[open_]), level), "round")
        best = rows.where("row is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
        best = run.table(best.select("item", "rank", "doc_id", "low"), "best")
        ends = best.groupBy("item").agg(F.count("*").alias("k"), F.min("low").alias("bar"))
        state = rows.where("row is null").groupBy("item").agg(F.max("unseen").alias("unseen"), F.sum("n_open").alias("n_open")).join(ends, "item", "left").toArrow()  # a row an item
        now, unseen, n_open = (state[c].to_numpy() for c in ("item", "unseen", "n_open"))
        full = state["k"].fill_null(0).to_numpy() == TOP
        bar = np.where(full, state["bar"].fill_null(0).to_numpy(), 0)
        bars[open_[now]] = np.maximum(bars[open_[now]], bar)
        final = (n_open == 0) & (full & (unseen < bar) | (level == LEVELS - 1))
        found.append(best.join(F.broadcast(spark.createDataFrame([(int(i), int(names[open_[i]])) for i in now[final]], "item long, number long")), "item").select(F.col("number").alias("item"), "rank", "doc_id", F.col("low").alias("score")))
        run.drop(rows)
        open_ = np.setdiff1d(open_, open_[now[final]])
    out = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    for f in found:
        out = out.unionByName(f)
    return run.table(out, "found")


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of the TOP best documents of each item."""
    spark = docs.sparkSession
    run = Run(spark, "search")
    small_batches(spark)
    wanted = run.table(item_terms(items), "items")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, -(-wanted.count() // BLOCK_TERMS))
    out = None
    for b in range(blocks):
        found = _search_block(run, slim, wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b))
        out = found if out is None else out.unionByName(found)
    names = wanted.select("item", "item_id").distinct()
    return run.result(out.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP11_SQL = f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM len),
f AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, docs),
p AS (SELECT i.item_id, f.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total))))) AS BIGINT) AS score FROM i JOIN f USING (term) JOIN w USING (term) JOIN len ON len.doc_id = f.doc_id, s GROUP BY i.item_id, f.doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""
