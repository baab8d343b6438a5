"""Jaccard join of 4-word shingle sets by a prefix tree of ordered sets.

Links are pairs of texts with 100 * common shingles >= 85 * shingles of either; their components are returned.

1. Equal sets are one class. By the hash of its shingles, the first quarter of a set is its head. Two
   linked sets have more than 8.5 % of their size in common among their heads, so classes whose heads hold
   less that is found in other heads have no link.
2. What is left is brought into one global order, the shingles of most classes first. In it a set is a
   path, and sets of a group share the long first part of their paths. Shingles of one class alone only
   count. A set of which less than 85 % is found in others has no link.
3. Linked sets share one of the rarest 15 % (and one) of either. By those shingles classes meet, first each
   with two hubs (:func:`near_dedup.settle`), then those of different components with each other.
4. For each set the sets that it meets are stored in a prefix tree (:class:`PrefixTree`) and walked from the
   root: the overlap of a shared part is counted once for all below it, and a subtree is left as soon as what
   remains of the sets can't bring enough. Each link comes from such a walk.

A tree holds up to PER_TREE sets; those of a set that meets more are dealt over several trees, in
several tasks. A hub's group makes a row a member, so work grows with the number of classes. Links inside a
component that hubs have connected already aren't looked for.

Defined results: null or empty texts and those without a word have no shingle and no link; they are
components of their own. Rows are nodes, whatever their doc_id: of two texts under one doc_id each has its
own links, and repeated rows give equal rows. ``component_id`` is the smallest doc_id in the component that
isn't null, else null. Columns beside doc_id and text are ignored. No documents: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import near_dedup
from .store import Run, give_back, read_documents, small_batches

WORDS, PERCENT = 4, 85
#: Sets in one tree; more are dealt over several.
PER_TREE = 128

_SKETCH = "doc_id long, text_hash long, n_shingles long, set_hi long, set_lo long, head array<long>"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, values, n in near_dedup.text_sets(batch.column("text"), WORDS):
            digests = near_dedup.set_digests(values, n)
            first = np.concatenate(([0], np.cumsum(n)))[:-1]
            k = np.where(n > 0, n // 4 + 1, 0)
            ends = np.concatenate(([0], np.cumsum(k)))
            heads = values[np.repeat(first - ends[:-1], k) + np.arange(ends[-1])].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(heads))
            ids = [batch.column(c).slice(i, j - i) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(n), pa.array(digests[:, 0]), pa.array(digests[:, 1]), lists], ["doc_id", "text_hash", "n_shingles", "set_hi", "set_lo", "head"])
    give_back()


def with_shared_heads(run: Run, classes: DataFrame) -> DataFrame:
    """class_id of those whose head has enough in common with other heads for a link."""
    heads = classes.select("class_id", "n_shingles", F.explode("head").alias("shingle"))
    shared = heads.groupBy("shingle").agg(F.count("*").alias("k")).where("k > 1").select("shingle")
    met = heads.join(shared.hint("shuffle_hash"), "shingle").groupBy("class_id").agg(F.count("*").alias("k"), F.first("n_shingles").alias("n"))
    return run.table(met.where(f"k > floor({PERCENT} * n / 1000)").select("class_id"), "live")


def ordered_sets(run: Run, docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """class_id, n (set size) and path: places of its shared shingles in the global order, ascending.

    Shingles of many classes come first. Sets that others can't link with for lack of shared shingles are left out.
    """
    sets = near_dedup.class_sets(run, docs, classes, wanted, WORDS)
    each = sets.select("class_id", F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    order = run.table(often.orderBy(F.desc("df"), "shingle").withColumn("place", F.monotonically_increasing_id()).select("shingle", "place"), "order")
    paths = each.join(order, "shingle").groupBy("class_id").agg(F.array_sort(F.collect_list("place")).alias("path"))
    out = run.table(paths.join(sets.select("class_id", F.size("shingles").cast("long").alias("n")), "class_id").where(f"100 * size(path) >= {PERCENT} * n"), "paths")
    run.drop(sets, order)
    return out


def _prefixes(paths: DataFrame) -> DataFrame:
    """class_id, n, i (0: rarest), shingle (its place), rest, enters: the shingles by which classes meet."""
    n, own = F.col("n"), F.col("n") - F.size("path")
    probe = n - F.ceil(PERCENT * n / 100) + 1 - own
    entry = n - F.ceil(2 * PERCENT * n / (100 + PERCENT)) + 1 - own
    some = paths.withColumn("probe", probe.cast("int")).withColumn("entry", entry.cast("int")).where("probe > 0").withColumn("size", F.size("path"))
    rarest = F.reverse(F.expr("slice(path, size - least(probe, size) + 1, least(probe, size))"))
    return some.select("class_id", "n", "size", "entry", "probe", F.posexplode(rarest).alias("i", "shingle")).select("class_id", "n", "probe", "shingle", (F.col("i") < F.col("entry")).alias("enters"), (F.col("size") - F.col("i")).alias("rest"))


class PrefixTree:
    """Ordered sets as a tree of shared first parts.

    The sets lie in lexicographic order, in which those below a node are neighbours; a node is a range of
    them and the length of the part that all of them share.
    """

    def __init__(self, paths: list[np.ndarray], sizes: list[int]) -> None:
        self.names = sorted(range(len(paths)), key=lambda i: paths[i].astype(">i8").tobytes())
        self.paths = [paths[i] for i in self.names]
        self.sizes = np.array([sizes[i] for i in self.names], dtype=np.int64)
        self.lengths = np.array([len(p) for p in self.paths], dtype=np.int64)
        self.shared = np.zeros(len(paths), dtype=np.int64)  # with the set before it
        for i in range(1, len(paths)):
            k = min(self.lengths[i - 1], self.lengths[i])
            apart = np.flatnonzero(self.paths[i - 1][:k] != self.paths[i][:k])
            self.shared[i] = apart[0] if len(apart) else k

    def walk(self, path: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
        """Number of each set that is linked with the given one, and how many shingles they share."""
        todo = [(0, len(self.paths), 0, 0, 0)] if self.paths else []
        while todo:
            lo, hi, depth, overlap, at = todo.pop()
            end = int(self.lengths[lo] if hi == lo + 1 else self.shared[lo + 1 : hi].min())
            part = self.paths[lo][depth:end]
            if len(part):
                found = np.searchsorted(path, part)
                overlap += int((path[np.minimum(found, len(path) - 1)] == part).sum())
                at = int(np.searchsorted(path, part[-1], side="right"))
            room = min(int(self.lengths[lo:hi].max()) - end, len(path) - at)
            if (100 + PERCENT) * (overlap + room) < PERCENT * (size + int(self.sizes[lo:hi].min())):
                continue
            if hi == lo + 1:
                yield self.names[lo], overlap
                continue
            cuts = [lo, *(lo + 1 + np.flatnonzero(self.shared[lo + 1 : hi] == end)).tolist(), hi]
            todo.extend((a, b, end, overlap, at) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def _walk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by probe, part and is_member: each group is the probe and a tree of sets that it meets."""
    names = ["a", "b", "jaccard"]
    group, probe, ids, paths, sizes = None, None, [], [], []

    def links() -> list[tuple[int, int, float]]:
        if group is None:
            return []
        found = PrefixTree(paths, sizes).walk(probe[1], probe[2])
        return [(min(probe[0], ids[i]), max(probe[0], ids[i]), k / (probe[2] + sizes[i] - k)) for i, k in found]

    for batch in batches:
        out: list[tuple[int, int, float]] = []
        at = batch.column("path").offsets.to_numpy()
        flat = batch.column("path").values.to_numpy()
        cols = [batch.column(c).to_pylist() for c in ("probe", "part", "is_member", "class_id", "n")]
        for i, (p, part, member, c, n) in enumerate(zip(*cols, strict=True)):
            path = flat[at[i] : at[i + 1]].copy()
            if not member:
                out += links()
                group, probe, ids, paths, sizes = (p, part), (c, path, n), [], [], []
            else:
                ids.append(c)
                paths.append(path)
                sizes.append(n)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], names)
    last = links()
    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in last], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], names)


def tree_links(run: Run, paths: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) of class_ids that are links, with their similarity. Trees are of what the busier of two meets."""
    pairs = run.table(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.withColumn("jaccard", F.lit(None).cast("double"))
    often = pairs.select(F.explode(F.array("a", "b")).alias("probe")).groupBy("probe").agg(F.count("*").alias("k"))
    both = pairs.join(often.select(F.col("probe").alias("a"), F.col("k").alias("ka")), "a").join(often.select(F.col("probe").alias("b"), F.col("k").alias("kb")), "b")
    busy = (F.col("ka") > F.col("kb")) | ((F.col("ka") == F.col("kb")) & (F.col("a") < F.col("b")))
    met = both.select(F.when(busy, F.col("a")).otherwise(F.col("b")).alias("probe"), F.when(busy, F.col("b")).otherwise(F.col("a")).alias("class_id"), F.ceil(F.greatest("ka", "kb") / PER_TREE).cast("long").alias("parts"))
    met = run.table(met.withColumn("part", F.pmod(F.xxhash64("class_id"), "parts")), "met")
    members = met.select("probe", "part", F.lit(True).alias("is_member"), "class_id")
    probes = met.select("probe", "part").distinct().select("probe", "part", F.lit(False).alias("is_member"), F.col("probe").alias("class_id"))
    rows = members.unionByName(probes).join(paths, "class_id").select("probe", "part", "is_member", "class_id", "n", "path")
    out = run.table(rows.repartition("probe", "part").sortWithinPartitions("probe", "part", "is_member").mapInArrow(_walk_batches, "a long, b long, jaccard double"), "links")
    run.drop(met, pairs)
    return out


def links(run: Run, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b, jaccard) of class_ids that connect all linked classes."""
    live = with_shared_heads(run, classes)
    paths = ordered_sets(run, docs, classes, live)
    run.drop(live)
    heads = _prefixes(paths)
    ids = classes.select("class_id", F.col("first.doc_id").alias("doc_id"))
    index = heads.select("class_id", F.col("n").alias("n_shingles"), F.col("n").alias("keys"), F.col("shingle").alias("key")).join(ids, "class_id")
    across = lambda mixed: near_dedup.pairs_between(run, run.table(heads.join(mixed, "class_id"), "prefixes"), PERCENT)
    return near_dedup.settle(run, index, lambda pairs: tree_links(run, paths, pairs), across, PERCENT)


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    run = Run(docs.sparkSession, "jaccard_join")
    small_batches(docs.sparkSession)
    sketch = run.table(near_dedup.slim_texts(docs).mapInArrow(_sketch_batches, _SKETCH), "sketches")
    classes = near_dedup.set_classes(run, sketch, "head")
    rows = near_dedup.by_class(run, sketch.drop("head"), classes, links(run, docs, classes))
    names = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return run.result(rows.join(names, "root", "left").select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read_documents(spark, sf_dir))
