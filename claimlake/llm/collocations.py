"""Collocations: phrases of 2 to 4 words by language, counted by dynamic itemset counting.

The corpus lies in SHARDS shards, which are scanned in a circle. Languages and words are counted from the first
scan on. A longer phrase is counted from the scan after the one in which both of its subphrases (all words
but the last, and all but the first) have reached MIN_COUNT so far; so lengths are counted side by side, and
what is counted grows while the circle is scanned. Each phrase is counted in SHARDS scans in succession, one
full cycle, and its count is then exact.

A scan is a job over one shard: tasks count what may be active and add up their own counts before the
shuffle. Which phrases have reached the threshold is known to the tasks by bits of their hashes (2**BITS of
them, a fixed 2 MB, set by what was reached at all and in the last cycle); what the bits let through too
much goes in a join of the summed counts with the table of what was reached, broadcast up to BROADCAST_ROWS
rows. At most ``4 * SHARDS`` scans end it. Phrases are known by 64-bit hashes of their words and language.

Of each candidate the weakest cut counts: score floor(2000000 * a / (l + r)) for the counts a of the phrase, l
and r of its parts, in decimals where a product may pass 64 bits. A phrase goes if a longer candidate
around it has 80 % of its count.

Defined results: a null text counts as empty, a null lang as "und" (one with a lang "und"). Rows count each for
itself, repeated ones too. Further columns are ignored. No documents, or no phrase MIN_COUNT times: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from . import shingles as S
from .store import Run, give_back, read_documents, small_batches

MIN_COUNT, LONGEST, SHARDS, TOP = 30, 4, 2, 2000
BITS = 24
BROADCAST_ROWS = 1_000_000
#: Words that a task counts together.
TOGETHER = 1 << 20
_CUT = S.byte_table(b".,;:!?\n\x0b\x0c\r")
_BETWEEN = _CUT | S.byte_table(b" \t")

_ROW = "key long, size int, text string, before long, now long, act int, prefix long, suffix long"


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(65 - (8 * len(bits)).bit_length())  # as many high bits as there are to choose from
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _join(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return S.mix(first * np.uint64(0xD6E8FEB86659FD93) + last)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where one of each is, and how often it occurs.

    Plain sorting is several times as fast as sorting with an index, so the index takes the place of the low bits.
    Keys that differ in those alone may come in several rows, whose counts add up.
    """
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).view(np.int64)
    keys = keys[order]
    begin = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[begin], order[begin], np.diff(np.append(begin, len(keys)))


class _Counter:
    """Words of some texts, one after another, and the counts of the phrases among them."""

    def __init__(self, bits: tuple[np.ndarray, np.ndarray], singles: bool) -> None:
        self.bits, self.singles = bits, singles
        self.clear()

    def clear(self) -> None:
        self.words, self.pieces, self.langs, self.texts, self.n, self.names = [], [], [], [], 0, {}

    def add(self, batch: pa.RecordBatch) -> None:
        raw, at = S.text_bytes(batch.column("text"))
        langs = batch.column("lang_key").to_numpy().view(np.uint64)
        if self.singles:
            self.names.update(zip(langs.tolist(), batch.column("lang").to_pylist(), strict=True))
        for i, j in S.blocks(at, 1 << 21):
            block = raw[at[i] : at[j]]
            h, owner, starts, ends = S.word_hashes(block, at[i : j + 1] - at[i], _BETWEEN)
            cuts = np.cumsum(_CUT[block])
            self.words.append(h)
            self.pieces.append((cuts[starts] + owner if len(h) else starts) + (self.pieces[-1][-1] + 2 if self.pieces and len(self.pieces[-1]) else 0))
            if not len(h):
                self.words.pop()
                self.pieces.pop()
                continue
            self.langs.append(langs[i + owner])
            if self.singles:
                self.texts.append((S.lower(block), starts, ends))
            self.n += len(h)

    def rows(self) -> pa.RecordBatch:
        """Counts of all that may be active, and forget the texts."""
        lang, word, piece = (np.concatenate(x) for x in (self.langs, self.words, self.pieces))
        known, recent = self.bits
        out = []
        if self.singles:
            key, n = np.unique(lang, return_counts=True)
            out.append((key, 0, pa.array([self.names[k] for k in key.tolist()], pa.string()), n, None, None))
        one = _join(lang, word)
        if self.singles:
            key, first, n = _distinct(one)
            out.append((key, 1, self._text_at(first), n, lang[first], None))
        shorter = one
        for size in range(2, LONGEST + 1):
            whole = piece[size - 1 :] == piece[: len(piece) - size + 1]
            key = _join(shorter[:-1], one[size - 1 :])
            head, tail = shorter[:-1], shorter[1:]
            is_known, is_recent = _has(known, shorter), _has(recent, shorter)
            active = np.flatnonzero(whole & is_known[:-1] & is_known[1:] & (is_recent[:-1] | is_recent[1:]))
            some, first, n = _distinct(key[active])
            at = active[first]
            out.append((some, size, None, n, head[at], tail[at]))
            shorter = key
        self.clear()
        cols: dict[str, list[pa.Array]] = {c: [] for c in ("key", "size", "text", "before", "now", "act", "prefix", "suffix")}
        for key, size, text, n, prefix, suffix in out:
            k = len(key)
            cols["key"].append(pa.array(key.view(np.int64)))
            cols["size"].append(pa.array(np.full(k, size, np.int32)))
            cols["text"].append(pa.nulls(k, pa.string()) if text is None else text)
            cols["before"].append(pa.array(np.zeros(k, np.int64)))
            cols["now"].append(pa.array(n.astype(np.int64)))
            cols["act"].append(pa.array(np.zeros(k, np.int32)) if size < 2 else pa.nulls(k, pa.int32()))
            for name, part in (("prefix", prefix), ("suffix", suffix)):
                cols[name].append(pa.nulls(k, pa.int64()) if part is None else pa.array(part.view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in cols.values()], list(cols))

    def _text_at(self, words: np.ndarray) -> pa.Array:
        """The texts of some words, gathered in one go."""
        bases = np.cumsum([0, *[len(t[0]) for t in self.texts]])
        starts, ends = (np.concatenate([t[side] + base for t, base in zip(self.texts, bases, strict=False)])[words] for side in (1, 2))
        raw = np.concatenate([t[0] for t in self.texts])
        offsets = np.concatenate(([0], np.cumsum(ends - starts)))
        data = raw[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)]
        return pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def scan(shard: DataFrame, bits: Broadcast, singles: bool) -> DataFrame:
    """Counts, by task, of what may be active in one shard; of languages and words too with ``singles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(tuple(np.frombuffer(zstandard.decompress(b), np.uint8) for b in bits.value), singles)
        for batch in batches:
            counter.add(batch)
            if counter.n >= TOGETHER:
                yield counter.rows()
        if counter.n:
            yield counter.rows()
        give_back()

    return shard.select("lang", "lang_key", "text").mapInArrow(run, _ROW)


def _bits(reached: DataFrame) -> np.ndarray:
    """The bits that some phrases set; at most 2**BITS / 32 rows come to the driver."""
    at = F.shiftrightunsigned("key", 64 - BITS)
    # bytes are little-endian words of 32 bits
    rows = reached.select(F.shiftright(at, 5).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITS}) & 31 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 5), np.uint32)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def frequent(run: Run, docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, size, phrase and exact count of all languages (size 0), words and phrases counted ``min_count`` times."""
    spark = docs.sparkSession
    lang = F.coalesce("lang", F.lit("und"))
    slim = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_key"), F.coalesce("text", F.lit("")).alias("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS)).cast("int").alias("shard"))
    path = f"{run.path}/shards"
    slim.write.partitionBy("shard").parquet(path)
    shards = spark.read.schema("lang string, lang_key long, text string, shard int").parquet(path)
    none = np.zeros(1 << (BITS - 3), np.uint8)
    state, reached, n_reached, final = None, [], 0, []
    ever, recent = none, [none]  # bits of what was reached so far, and by each scan of the last cycle
    for t in range(LONGEST * SHARDS):
        known = spark.sparkContext.broadcast(tuple(zstandard.compress(np.bitwise_or.reduce([none, *b]).tobytes()) for b in ([ever], recent)))
        raw = scan(shards.where(F.col("shard") == t % SHARDS), known, t < SHARDS)
        if state is not None:
            carried = state.where(F.col("act") + SHARDS > t).select("key", "size", "text", (F.col("before") + F.col("now")).alias("before"), F.lit(0).cast("long").alias("now"), "act", F.lit(None).cast("long").alias("prefix"), F.lit(None).cast("long").alias("suffix"))
            raw = raw.unionByName(carried)
        sums = raw.groupBy("key", "size", "text").agg(*[F.sum(c).alias(c) for c in ("before", "now")], *[F.max(c).alias(c) for c in ("act", "prefix", "suffix")])
        if reached:
            when = _union(reached).select(F.col("key").alias("k"), F.col("scan").alias("s"))
            when = F.broadcast(when) if n_reached <= BROADCAST_ROWS else when
            # A null key meets nothing, so of phrases that are known to be active nothing is looked for.
            asked = sums.withColumn("p", F.when(F.col("act").isNull(), F.col("prefix"))).withColumn("q", F.when(F.col("act").isNull(), F.col("suffix")))
            both = asked.join(when.withColumnsRenamed({"k": "pk", "s": "ps"}), F.col("p") == F.col("pk"), "left").join(when.withColumnsRenamed({"k": "qk", "s": "qs"}), F.col("q") == F.col("qk"), "left")
            begun = F.when(F.col("ps").isNotNull() & F.col("qs").isNotNull(), F.greatest("ps", "qs") + 1)
            sums = both.withColumn("act", F.coalesce("act", begun)).drop("p", "q", "pk", "ps", "qk", "qs")
        total = F.col("before") + F.col("now")
        is_ended = (F.col("act") + SHARDS - 1 == t) & (total >= min_count)
        is_fresh = (F.col("before") < min_count) & (total >= min_count)
        seen = Observation()
        counted = {"ended": is_ended, "fresh": is_fresh, "counting": F.col("act") + SHARDS - 1 > t}
        now = sums.where(F.col("act").isNotNull() & (F.col("act") + SHARDS > t)).observe(seen, *[F.count_if(c).alias(name) for name, c in counted.items()])
        old, state = state, run.table(now, "state")
        known.destroy()
        if old is not None:
            run.drop(old)
        if seen.get["ended"]:
            final.append(run.table(state.where(is_ended).select("key", "size", total.alias("a")), "final"))
        fresh = state.where(is_fresh)
        names = fresh.where("size < 2").select("key", "size", F.coalesce("prefix", "key").alias("lang_key"), "text")
        if reached:
            so_far = _union(reached).select(F.col("key").alias("k"), "lang_key", "text")
            longer = fresh.where("size >= 2").select("key", "size", "prefix", "suffix").join(so_far.withColumnRenamed("text", "head"), F.col("prefix") == F.col("k")).drop("k")
            longer = longer.join(so_far.select("k", F.substring_index("text", " ", -1).alias("tail")), F.col("suffix") == F.col("k"))
            names = names.unionByName(longer.select("key", "size", "lang_key", F.concat_ws(" ", "head", "tail").alias("text")))
        latest = none
        if seen.get["fresh"]:
            reached.append(run.table(names.withColumn("scan", F.lit(t)), "reached"))
            n_reached += seen.get["fresh"]
            latest = _bits(reached[-1].where((F.col("size") > 0) & (F.col("size") < LONGEST)))
        ever, recent = ever | latest, [*recent, latest][-SHARDS:]
        if t + 1 >= SHARDS and not seen.get["counting"] and not any(b.any() for b in recent):
            break
    run.drop(state)
    if not final:
        return spark.createDataFrame([], "lang string, size int, phrase string, a long")
    names = _union(reached).select("key", "lang_key", "text")
    langs = names.join(_union(final).where("size = 0").select("key"), "key").select(F.col("key").alias("l"), F.col("text").alias("lang"))
    return run.table(_union(final).join(names, "key").join(langs, F.col("lang_key") == F.col("l")).select("lang", "size", F.col("text").alias("phrase"), "a"), "frequent")


def _wide(n: str) -> F.Column:
    return F.col(n).cast("decimal(20,0)")


def collocations(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's TOP collocations."""
    run = Run(docs.sparkSession, "collocations")
    small_batches(docs.sparkSession)
    counts = frequent(run, docs)
    phrases = counts.where("size >= 2").select("lang", "size", "phrase", "a")
    n = counts.where("size = 0").select("lang", F.col("a").alias("n"))
    known = counts.where("size between 1 and 3").select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("a").alias("times"))
    words = F.split("phrase", " ")
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).withColumnRenamed("times", name).drop("of", "part")
    score = F.expr("cast(cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r) as long)")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = phrases.where("size > 2").select("lang", F.col("a").alias("b"), "size", words.alias("w")).withColumn("m", F.explode(F.expr("sequence(2, size - 1)"))).withColumn("i", F.explode(F.expr("sequence(1, size - m + 1)")))
    around = inner.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), "b").groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    own = weakest.join(around, ["lang", "phrase"], "left").where(F.col("b").isNull() | (_wide("b") * 100 < _wide("a") * 80))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = own.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= TOP)
    return run.result(best.join(n, "lang").select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_documents(spark, sf_dir))


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, a, j, array_to_string(s[1:j], ' ') AS lp, array_to_string(s[j + 1:k], ' ') AS rp FROM (SELECT *, string_split(phrase, ' ') AS s, unnest(range(1, k)) AS j FROM f WHERE k > 1)),
q AS (SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (l.a + r.a) AS BIGINT) AS score, j FROM c JOIN f l ON l.lang = c.lang AND l.phrase = lp JOIN f r ON r.lang = c.lang AND r.phrase = rp),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS best FROM q) WHERE best = 1),
u AS (SELECT lang, array_to_string(s[i:i + m - 1], ' ') AS phrase, max(a) AS around FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, string_split(phrase, ' ') AS s, unnest(range(2, k)) AS m FROM f WHERE k > 2)) GROUP BY 1, 2),
o AS (SELECT b.* FROM b LEFT JOIN u USING (lang, phrase) WHERE around IS NULL OR 100 * around < 80 * b.a)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang)) WHERE rank <= 2000
"""
