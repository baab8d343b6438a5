"""Packing token pieces into sequences of bounded length by linear grouping and best fit.

Method. How often each length occurs is all that the plan needs: at most 2048 counts, whatever the
corpus. On those counts

1. large lengths (over a third of the capacity, so two at most in a sequence) are cut into groups of equal cardinality and
   rounded up to the largest length of their group, so few sizes remain;
2. the fewest sequences for these sizes are found over all configurations (multisets of sizes that
   fit) by a linear programme; the whole part of its solution is used;
3. each slot of a configuration gets a real length of its group, largest first, which frees the room
   that rounding took;
4. the few large lengths that the fractions left over and then all small ones, in descending order,
   go where they fit best.

All of this handles runs of equal sequences, never one by one, so the plan is a table of runs. Each
piece is numbered among those of its length by two counts (within a shard, over shards) and finds its
place in the plan by that number; pieces never meet in one task, however frequent a length is.

Defined results: a null or empty text has one token, the end id. Repeated rows are packed as often as
they occur. No documents: no rows. Further columns are ignored.
"""

from __future__ import annotations

import warnings
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialise, read_documents, small_batches
from .tokens import default_tokenizer, encoder

CAPACITY = 2048
GROUPS = 512
#: Turns of the simplex method for each size, at most; it says so if they don't suffice.
TURNS = 40
#: Pieces of one length that a shard holds, about; shards are numbered apart from each other.
PER_SHARD = 20_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids: one, or, if it is too long, several of which all but the first are full."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for i, j, ids, counts in ids_of.encode(batch.column("text")):
                raw, at = ids.astype("<u4", copy=False), np.cumsum(counts) - counts
                rows: list[list] = [[], [], [], [], [], []]
                for k in range(j - i):
                    n, begin = int(counts[k]), 0
                    first = n if n <= capacity else (n - 1) % capacity + 1
                    piece = 0
                    while begin < n:
                        end = begin + (first if piece == 0 else capacity)
                        one = raw[at[k] + begin : at[k] + end].tobytes()
                        for column, value in zip(rows, (doc_ids[i + k], piece, begin, end - begin, zlib.crc32(one), one if with_ids else None), strict=True):
                            column.append(value)
                        begin, piece = end, piece + 1
                out = [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:5])]
                if with_ids:
                    out.append(pa.array(rows[5], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInArrow(cut, _PIECES + (", ids binary" if with_ids else ""))


# ---- the plan, on counts of lengths only


def _configurations(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """One size or any two that fit, as rows of two indexes; len(sizes) stands for none."""
    i, j = np.triu_indices(len(sizes) + 1)
    size = np.append(sizes, 0)
    return np.stack([i, j], 1)[(size[i] + size[j] <= capacity) & (i < len(sizes))]


def _optimise(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """How often to use which configurations (columns): fractional bin packing by the revised simplex method.

    A turn enters the configuration whose sizes are worth most at the current prices; none is worth
    more than the one sequence that it costs, once the solution is optimal.
    """
    m = len(sizes)
    rows = _configurations(sizes, capacity)
    basis = np.diag((capacity // sizes).clip(max=2).astype(float))
    inverse = np.linalg.inv(basis)
    x = inverse @ demand
    for turn in range(TURNS * m):
        price = np.append(inverse.sum(axis=0), 0)
        worth = price[rows[:, 0]] + price[rows[:, 1]]
        best = int(np.argmax(worth))
        if worth[best] <= 1 + 1e-7:
            break
        column = np.bincount(rows[best], minlength=m + 1)[:m].astype(float)
        direction = inverse @ column
        up = direction > 1e-9
        out = int(np.argmin(np.where(up, x / np.where(up, direction, 1), np.inf)))
        basis[:, out] = column
        if turn % 50 == 49:
            inverse = np.linalg.inv(basis)
        else:
            row = inverse[out] / direction[out]
            inverse = inverse - np.outer(direction, row)
            inverse[out] = row
        x = np.maximum(inverse @ demand, 0)
    else:
        warnings.warn("the linear programme was stopped before its optimum; the packing is valid but may be looser", RuntimeWarning, stacklevel=2)
    return basis, x


class Plan:
    """Runs of equal sequences: lists of (lengths in order, how many sequences)."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, n_groups: int = GROUPS) -> None:
        self.capacity = capacity
        left = {int(k): int(v) for k, v in counts.items() if v}
        runs: list[tuple[tuple[int, ...], int]] = []
        if n := left.pop(capacity, 0):
            runs.append(((capacity,), n))
        large = sorted((s for s in left if s > capacity // 3), reverse=True)
        runs += self._large(large, left, n_groups)
        self.runs = self._small(runs, {s: n for s, n in left.items() if n})
        self.n_sequences = sum(n for _, n in self.runs)

    def _large(self, large: list[int], left: dict[int, int], n_groups: int) -> list[tuple[tuple[int, ...], int]]:
        if not large:
            return []
        per_group = -(-sum(left[s] for s in large) // n_groups)
        queue: list[list[list[int]]] = []  # of each group: [length, count] in descending order
        sizes: list[int] = []
        room = 0
        for s in large:
            n = left.pop(s)
            while n:
                if room == 0:
                    queue.append([])
                    sizes.append(s)
                    room = per_group
                take = min(n, room)
                queue[-1].append([s, take])
                n, room = n - take, room - take
        # Groups that were rounded to the same size are one.
        by_size: dict[int, list[list[int]]] = {}
        for s, q in zip(sizes, queue, strict=True):
            by_size.setdefault(s, []).extend(q)
        sizes = sorted(by_size, reverse=True)
        demand = np.array([sum(n for _, n in by_size[s]) for s in sizes], dtype=float)
        basis, x = _optimise(np.array(sizes), demand, self.capacity)
        have = demand.astype(np.int64)
        runs: list[tuple[tuple[int, ...], int]] = []
        for p in np.argsort(-x):
            column = np.rint(basis[:, p]).astype(np.int64)
            fits = [int(have[i] // column[i]) for i in np.flatnonzero(column)]
            if n := min([int(x[p] + 1e-9), *fits]):
                have -= n * column
                slots = [self._take(by_size[sizes[i]], n) for i in range(len(sizes)) for _ in range(column[i])]
                runs += self._align(slots, n)
        for q in by_size.values():  # what the fractions leave over: a few sequences' worth
            for s, n in q:
                left[s] = left.get(s, 0) + n
        return runs

    @staticmethod
    def _take(queue: list[list[int]], n: int) -> list[tuple[int, int]]:
        """The next n real lengths of a group, as runs."""
        out = []
        while n:
            s, c = queue[0]
            take = min(n, c)
            out.append((s, take))
            n -= take
            queue[0][1] -= take
            if take == c:
                queue.pop(0)
        return out

    @staticmethod
    def _align(slots: list[list[tuple[int, int]]], n: int) -> list[tuple[tuple[int, ...], int]]:
        """Runs of whole sequences out of the runs of each slot."""
        ends = [np.cumsum([c for _, c in slot]) for slot in slots]
        cuts = np.unique(np.concatenate(ends))
        at = np.concatenate(([0], cuts[:-1]))
        lengths = [np.array([s for s, _ in slot])[np.searchsorted(e, at, side="right")] for slot, e in zip(slots, ends, strict=True)]
        return [(tuple(int(x) for x in row), int(c)) for row, c in zip(np.stack(lengths, 1), np.diff(cuts, prepend=0), strict=True)]

    def _small(self, runs: list[tuple[tuple[int, ...], int]], left: dict[int, int]) -> list[tuple[tuple[int, ...], int]]:
        """Best fit, in descending order of length, into the room that is left; new sequences where there is none."""
        by_room: dict[int, list[list]] = defaultdict(list)
        for lengths, n in runs:
            by_room[self.capacity - sum(lengths)].append([lengths, n])
        for s in sorted(left, reverse=True):
            n = left[s]
            while n:
                room = min((r for r in by_room if r >= s and by_room[r]), default=None)
                if room is None:
                    lengths, count, room = (), -(-n // (self.capacity // s)), self.capacity
                else:
                    lengths, count = by_room[room].pop()
                each = room // s
                full = min(count, n // each)
                if full:
                    by_room[room - each * s].append([lengths + (s,) * each, full])
                    n -= full * each
                if full < count:
                    rest = n if full == 0 or n < each else 0
                    if rest:
                        by_room[room - rest * s].append([lengths + (s,) * rest, 1])
                        n -= rest
                    if (spare := count - full - bool(rest)) and lengths:
                        by_room[room].append([lengths, spare])
        return [(tuple(a), n) for group in by_room.values() for a, n in group if n]

    def table(self) -> dict[int, np.ndarray]:
        """For each length rows of (first number, sequences in the run, first sequence_id, offset), by number."""
        out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        given: dict[int, int] = defaultdict(int)
        sequence = 0
        for lengths, n in self.runs:
            offset = 0
            for s in lengths:
                out[s].append((given[s], n, sequence, offset))
                given[s] += n
                offset += s
            sequence += n
        return {s: np.array(rows, dtype=np.int64) for s, rows in out.items()}


def numbered(parts: DataFrame) -> DataFrame:
    """``parts`` with ``number``: 0, 1, ... among the pieces of the same length."""
    n = parts.count()
    shards = max(16, -(-n // PER_SHARD))
    cut = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    sizes = cut.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("length", "shard", "before")
    # Rows that are equal in all of these are interchangeable, so a task that runs again gives the same places.
    within = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    return cut.withColumn("within", within).join(before, ["length", "shard"]).withColumn("number", F.col("within") + F.col("before")).drop("within", "before", "shard")


def assign(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = Plan(counts, capacity).table()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for s in np.unique(length):
                here, rows = length == s, table[int(s)]
                at = np.searchsorted(rows[:, 0], number[here], side="right") - 1
                sequence[here] = rows[at, 2] + number[here] - rows[at, 0]
                offset[here] = rows[at, 3]
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered(parts).mapInArrow(place, _PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Place of every piece of every document: sequence_id and offset, beside its own start, length and CRC-32."""
    return assign(materialise(pieces(docs, tokenizer, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and its ids as bytes: the packed training rows themselves."""
    ids = pieces(docs, tokenizer, capacity, with_ids=True).select("doc_id", "piece", "ids")
    rows = placed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return rows.select("sequence_id", joined.alias("ids"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_documents(spark, sf_dir), default_tokenizer())
