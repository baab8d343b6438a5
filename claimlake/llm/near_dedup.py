"""Near-duplicate groups by a multi-index Hamming join of MinHash signatures.

Method. Every text becomes the set of its 5-word shingles and a signature of 64 symbols of b = 16
bits, packed as 16 chunks of four symbols. Signatures that differ in at most 31 symbols must, by
pigeonhole, differ in at most one symbol of some chunk; so each signature is entered in the index
under all 16 x 4 chunks with one symbol struck out, and any two signatures within that distance meet
under a key. Two texts of Jaccard similarity 0.75 are further apart than that with a probability of
about 1e-5, falling fast above 0.75. What meets, is close enough and of like size is then confirmed
on the full sets.

Work that a large group of copies could blow up:

* texts with the same set are one class from the start; only classes are joined;
* a class is first held against two hubs, never against all: of the classes it meets, the one that meets the
  most under its keys, and that of the smallest doc_id. So the origin of a group of variants meets all of
  them, however documents are numbered, and a turn makes two pairs a class at most. Further turns take
  hubs of other components at random while that leaves fewer;
* then only classes are left that meet one of another component under some key. Whether such two are
  linked is settled on their full sets by prefixes: with shingles in order of rarity, sets of
  similarity 0.75 share one of the first quarter of the larger and of the first seventh of the
  smaller. Texts that merely share a passage, however many, have their own words there and make no pair.
  Under a shingle, the largest component's classes only meet those of others, and a shingle of many
  classes is dealt over several tasks.

Defined results: null or empty texts, and texts without words, have n_shingles 0, are linked with
nothing and stay. Rows are nodes, whatever their doc_id: of two texts under one doc_id each has its own
links, and repeated rows give equal rows. ``component_id`` is the smallest doc_id that is not null in
the component, else null; ``kept`` is true for its rows, or, if it is null, for all of the component.
:func:`deduplicate` keeps one row of each component even then. Columns beside the two needed pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import shingles as S
from .store import Run, give_back, packed, small_batches, unpacked

SYMBOLS, SYMBOL_BITS, PER_CHUNK = 64, 16, 4
CHUNKS = SYMBOLS // PER_CHUNK
#: Pigeonhole: 16 chunks, one error allowed in a chunk.
MAX_DISTANCE = 2 * CHUNKS - 1
#: Ids up to this many are broadcast (a few tens of MB); above, the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Classes under one shingle that one task holds against others.
PER_PART = 4_000
#: Turns of hubs at most, and so few classes as meet each other without a further turn. No link depends on these.
TURNS, FEW_CLASSES = 4, 1_000


def set_digests(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """128 bits of each set, as two longs: sums modulo 2**64, which are the same for the same set."""
    begin = np.concatenate(([0], np.cumsum(n)))
    sums = np.concatenate((np.zeros((1, 2), np.uint64), np.cumsum(np.stack([values, S.mix(values)], 1), axis=0, dtype=np.uint64)))
    return (sums[begin[1:]] - sums[begin[:-1]]).view(np.int64)


def text_sets(texts: pa.Array, words: int = S.WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with the distinct shingle hashes of each, one after another, and their counts."""
    raw, at = S.text_bytes(texts)
    for i, j in S.blocks(at):
        h, owner, _, _ = S.word_hashes(raw[at[i] : at[j]], at[i : j + 1] - at[i])
        values, n = S.distinct_per_text(*S.shingle_hashes(h, owner, j - i, words))
        yield i, j, values, n


_SKETCH = "doc_id long, text_hash long, n_shingles long, set_hi long, set_lo long, chunks array<long>"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = S.permutations(SYMBOLS)
    shift = np.arange(PER_CHUNK, dtype=np.uint64) * np.uint64(SYMBOL_BITS)
    for batch in batches:
        for i, j, values, n in text_sets(batch.column("text")):
            low = S.mix(S.signatures(values, n, a, b)) >> np.uint64(64 - SYMBOL_BITS)
            chunks = np.bitwise_or.reduce(low.reshape(len(n), CHUNKS, PER_CHUNK) << shift, axis=2).view(np.int64).ravel()
            digests = set_digests(values, n)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * CHUNKS), pa.array(chunks))
            ids = [batch.column(c).slice(i, j - i) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(n), pa.array(digests[:, 0]), pa.array(digests[:, 1]), lists], ["doc_id", "text_hash", "n_shingles", "set_hi", "set_lo", "chunks"])
    give_back()


def slim_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and its hash."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, 128-bit digest of the set and signature of every text."""
    return slim_texts(docs).mapInArrow(_sketch_batches, _SKETCH)


def set_classes(run: Run, sketch: DataFrame, carry: str) -> DataFrame:
    """One row for each distinct set: class_id, n_shingles, digest, its smallest (doc_id, text_hash), ``carry``."""
    some = sketch.where("n_shingles > 0").groupBy("set_hi", "set_lo", "n_shingles").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first(carry).alias(carry))
    return run.table(some.withColumn("class_id", F.monotonically_increasing_id()), "classes")


def class_sets(run: Run, docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int = S.WORDS) -> DataFrame:
    """Full shingle sets of the classes in ``wanted`` (class_id, distinct), from the text that represents each."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i, j, values, n in text_sets(batch.column("text"), words):
                ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("class_id").slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))], ["class_id", "shingles"])
        give_back()

    names = run.table(classes.join(wanted, "class_id").select("class_id", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")), "wanted")
    ids = F.broadcast(names) if names.count() <= BROADCAST_ROWS else names
    texts = slim_texts(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).select("class_id", "text")
    sets = run.table(texts.mapInArrow(batches, "class_id long, shingles array<long>").dropDuplicates(["class_id"]), "sets")
    run.drop(names)
    return sets


def _keys() -> Column:
    """The 64 index keys of a signature: each chunk with each of its symbols struck out."""
    every = (1 << 64) - 1
    keys = []
    for c in range(CHUNKS):
        for s in range(PER_CHUNK):
            mask = every ^ (((1 << SYMBOL_BITS) - 1) << (s * SYMBOL_BITS))
            signed = mask - (1 << 64) if mask >> 63 else mask
            keys.append(F.xxhash64(F.lit(c * PER_CHUNK + s), F.col("chunks")[c].bitwiseAND(F.lit(signed).cast("long"))))
    return F.explode(F.array(*keys))


def _distance(a: str, b: str) -> Column:
    """Count of symbols in which two signatures differ."""

    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for n in (8, 4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, n))
        return F.bit_count(z.bitwiseAND(F.lit(0x0001000100010001)))

    return F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda s, d: s + d)


def _within_distance(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    sig = classes.select("class_id", "chunks")
    both = pairs.join(sig.select(F.col("class_id").alias("a"), F.col("chunks").alias("ca")), "a").join(sig.select(F.col("class_id").alias("b"), F.col("chunks").alias("cb")), "b")
    return both.where(_distance("ca", "cb") <= MAX_DISTANCE).select("a", "b")


def _like_size(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes alone rule out so high a similarity need no look."""
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def confirmed(run: Run, docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) of class_ids with Jaccard similarity >= 0.75 on full sets, and that similarity."""
    pairs = run.table(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.withColumn("jaccard", F.lit(None).cast("double"))
    sets = class_sets(run, docs, classes, pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct())
    both = pairs.join(sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("sb")), "b")
    size = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("common"), (F.size("sa") + F.size("sb")).alias("sizes"))
    links = run.table(size.where("100 * common >= 75 * (sizes - common)").select("a", "b", (F.col("common") / (F.col("sizes") - F.col("common"))).alias("jaccard")), "links")
    run.drop(sets, pairs)
    return links


def _across(run: Run, docs: DataFrame, classes: DataFrame, mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components in ``mixed`` (class_id, root) that may have similarity 0.75.

    None that has is missing: if |x| >= |y|, such sets share one of the |x| - ceil(3|x|/4) + 1 rarest
    shingles of x that is one of the |y| - ceil(6|y|/7) + 1 rarest of y; and from the first that they
    share on, either still has room for the 3/7 (|x| + |y|) that they must have in common.
    """
    if mixed.isEmpty():
        return run.table(mixed.select(F.col("class_id").alias("a"), F.col("root").alias("b")), "across")
    sets = class_sets(run, docs, classes, mixed.select("class_id"))
    each = sets.select("class_id", F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = each.join(often, "shingle").groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("common"))
    n = F.col("n")
    own = n - F.size("common")  # shingles that no other text has come first
    heads = (
        ranked.join(sets.select("class_id", F.size("shingles").alias("n")), "class_id")
        .join(mixed, "class_id")
        .withColumn("probe", n - F.floor((3 * n + 3) / 4).cast("int") + 1 - own)
        .withColumn("entry", n - F.floor((6 * n + 6) / 7).cast("int") + 1 - own)
        .where("probe > 0")
        .withColumn("own", own)
        .withColumn("common", F.slice("common", 1, F.greatest("probe", F.lit(0))))
        .select("class_id", "root", "n", "entry", "own", F.posexplode("common").alias("i", "c"))
        .select("class_id", "root", "n", (F.col("i") < F.col("entry")).alias("enters"), (n - F.col("own") - F.col("i")).alias("rest"), F.col("c.shingle").alias("shingle"))
    )
    heads = run.table(heads, "prefixes")
    run.drop(sets)
    return pairs_between(run, heads, 75)


def pairs_between(run: Run, heads: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of classes of different components that share a shingle of ``heads``.

    ``heads`` has class_id, root, n (set size), shingle, rest (shingles of the set from this one on), and enters:
    whether it is one of those that suffice for the smaller set of a pair. It goes. Pairs that size or rest rule out
    are left out.
    """
    # Only shingles of several components matter. The largest component under a shingle needn't meet itself, so
    # no more pairs are looked at than twice those of different components.
    by_root = heads.groupBy("shingle", "root").agg(F.count("*").alias("k"))
    at = by_root.groupBy("shingle").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.sum("k").alias("k"), F.count("*").alias("roots")).where("roots > 1").select("shingle", "main", "k")
    marked = run.table(heads.join(at, "shingle").withColumn("is_main", F.col("root") == F.col("main")).withColumn("parts", F.ceil(F.col("k") / PER_PART).cast("int")).drop("main", "k"), "marked")
    run.drop(heads)
    to = F.explode(F.when(F.col("is_main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
    x = marked.select("shingle", to.alias("side"), F.pmod(F.xxhash64("class_id"), "parts").alias("part"), F.col("class_id").alias("x"), F.col("n").alias("nx"), F.col("root").alias("rx"), F.col("rest").alias("tx"))
    y = marked.where("enters").select("shingle", F.col("is_main").alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"), F.col("class_id").alias("y"), F.col("n").alias("ny"), F.col("root").alias("ry"), F.col("rest").alias("ty"))
    pairs = x.join(y, ["shingle", "side", "part"]).where(f"rx <> ry and nx >= ny and 100 * ny >= {percent} * nx and {100 + percent} * least(tx, ty) >= {percent} * (nx + ny)")
    out = run.table(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "across")
    run.drop(marked)
    return out


def components(edges: DataFrame, run: Run | None = None) -> DataFrame:
    """Smallest node that each node of ``edges`` (a, b) reaches, by alternating large-star and small-star.

    Columns node, root. Each round is two joins on sums of what a task has, so a hub needs no list of its
    neighbours; the number of rounds grows with the logarithm of a component's size.
    """
    run = run or Run(edges.sparkSession, "components")

    def write(df: DataFrame) -> tuple[DataFrame, tuple]:
        """The table, with its count and a sum of its rows' hashes as they were written."""
        seen = Observation()
        out = run.table(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash")), "edges")
        return out, (seen.get["n"], seen.get["hash"])

    now, state = write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while state[0] and state != before:
        before = state
        sides = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = sides.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        old, (now, state) = now, write(small)
        run.drop(old)
    out = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out.shared_path = now.shared_path
    return out


def settle(run: Run, index: DataFrame, confirm: Callable[[DataFrame], DataFrame], across: Callable[[DataFrame], DataFrame], percent: int = 75) -> DataFrame:
    """Links that connect all classes of so high a similarity that meet under a key of ``index``.

    ``index`` has key, class_id, n_shingles, doc_id and keys (how many the class may have, or its size); ``confirm`` returns
    those of some pairs (a, b) that are links, ``across`` the pairs of different components among classes
    (class_id, root) that may be. A link that would only close a circle inside a component need not be listed.
    """
    several = index.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    met = index.join(several, "key")
    left = run.table(met.select("key", "class_id", "n_shingles", "doc_id", "k"), "shared")
    rank = run.table(met.groupBy("class_id").agg((F.sum("k") / F.first("keys")).alias("rank")), "ranks")
    first = left.join(rank, "class_id").withColumn("root", F.col("class_id"))
    found = confirm(_hub_pairs(first, percent).unionByName(_hub_pairs(first.withColumn("rank", -F.col("doc_id").cast("double")), percent)).distinct())
    run.drop(rank)
    before = None
    for turn in range(1, TURNS + 1):
        left = _mixed(run, left, components(found.select("a", "b"), run))
        nodes = left.select("class_id", "root").distinct()
        n = nodes.count()
        if turn == TURNS or n <= FEW_CLASSES or (before is not None and 2 * n > before):
            break
        before = n
        found = found.unionByName(confirm(_hub_pairs(left.withColumn("rank", F.xxhash64("class_id", F.lit(turn)).cast("double")), percent)))
    mixed = run.table(nodes, "mixed")
    run.drop(left)
    pairs = across(mixed)
    run.drop(mixed)
    return found.unionByName(confirm(pairs))


def _mixed(run: Run, rows: DataFrame, root: DataFrame) -> DataFrame:
    """``rows`` under keys of several components, with each class's root.

    Takes the place of ``rows`` and ``root``, which go.
    """
    bare = rows.drop("root")
    at = run.table(bare.join(root.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("root", F.coalesce("root", "class_id")), "placed")
    run.drop(root, rows)
    several = at.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    out = run.table(at.join(several, "key", "left_semi"), "left")
    run.drop(at)
    return out


def _hub_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each class with one other: of the hubs of its keys, the one of the highest rank.

    The hub of a key is its class of the highest rank, then smallest class_id. At most one pair a class, and none
    inside a component.
    """
    hub = rows.groupBy("key").agg(F.max(F.struct(F.coalesce("rank", F.lit(float("-inf"))).alias("rank"), (-F.col("class_id")).alias("minus"), "n_shingles", "root")).alias("hub"))
    both = rows.select("key", "class_id", "n_shingles", "root").join(hub, "key").where("root <> hub.root").withColumn("nh", F.col("hub.n_shingles"))
    chosen = both.where(_like_size("n_shingles", "nh", percent)).groupBy("class_id").agg(F.max("hub").alias("hub")).select("class_id", (-F.col("hub.minus")).alias("h"))
    return chosen.select(F.least("h", "class_id").alias("a"), F.greatest("h", "class_id").alias("b")).distinct()


def placed(run: Run, docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles and root (a class_id; null without shingles) of every row."""
    small_batches(docs.sparkSession)
    sketch = run.table(sketches(docs), "sketches")
    classes = set_classes(run, sketch, "chunks")
    index = classes.select("class_id", "n_shingles", F.col("first.doc_id").alias("doc_id"), F.lit(CHUNKS * PER_CHUNK).alias("keys"), _keys().alias("key"))
    links = settle(run, index, lambda pairs: confirmed(run, docs, classes, _within_distance(pairs, classes)), lambda mixed: _across(run, docs, classes, mixed))
    return by_class(run, sketch.drop("chunks"), classes, links)


def by_class(run: Run, sketch: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles and root of each row of ``sketch``, from links (a, b) of classes."""
    root = components(links.select("a", "b"), run)
    names = classes.select("set_hi", "set_lo", F.col("n_shingles").alias("n"), "class_id").join(root.withColumnRenamed("node", "class_id"), "class_id", "left").select("set_hi", "set_lo", "n", F.coalesce("root", "class_id").alias("root"))
    names = names.withColumnsRenamed({"set_hi": "_hi", "set_lo": "_lo"})
    on = (F.col("set_hi") == F.col("_hi")) & (F.col("set_lo") == F.col("_lo")) & (F.col("n_shingles") == F.col("n"))
    return run.table(sketch.join(names, on, "left").select("doc_id", "text_hash", "n_shingles", "root"), "placed")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept (doc_id is that one)."""
    run = Run(docs.sparkSession, "near_dedup")
    rows = placed(run, docs)
    names = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(names, "root", "left").select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return run.result(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (null last), then text hash.

    Repeated rows of it are one. Rows without shingles all stay.
    """
    run = Run(docs.sparkSession, "near_dedup")
    rows = placed(run, docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = rows.where("root is not null").groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash"), order).alias("best"))
    copies = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("k"))
    bare = rows.where("root is null").select("doc_id", "text_hash").distinct().select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"), F.lit(1).cast("long").alias("_copies"))
    same = F.col("b.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("b.text_hash") == F.col("c.text_hash"))
    kept = best.select("best.*").alias("b").join(copies.alias("c"), same).select(F.col("b.doc_id").alias("_kept_id"), F.col("b.text_hash").alias("_kept_hash"), F.col("k").alias("_copies"))
    kept = run.result(kept.unionByName(bare))
    all_ = packed(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("i"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "_row")
    held = all_.join(kept, F.col("i").eqNullSafe(F.col("_kept_id")) & (F.col("h") == F.col("_kept_hash")))
    once = held.where("_copies = 1").select("_row")
    if not kept.where("_copies > 1").isEmpty():
        once = once.unionByName(held.where("_copies > 1").select("i", "h", "_row").dropDuplicates(["i", "h"]).select("_row"))
    return unpacked(once, docs.columns)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .store import read_documents

    return groups(read_documents(spark, sf_dir))
