"""Language of each word and text by a linear-chain conditional random field.

A word's features are its affixes (one to four bytes at either end), its byte trigrams and its lower
case form (the lexicon), each hashed to a row of weights; labels of neighbouring words share learned
transitions. Forward-backward gives each word the probability of each language, given the whole text,
so a passage in another language is labelled as such. A text's language is that with the largest
sum of probabilities, and the score is its share.

The model is trained in a few seconds on the driver from a bounded sample of rows: TRAIN_DOCS labelled
documents, as many of each language, but LEAST_DOCS of each at least, however many languages there
are. They are the smallest hashes of doc_id within as many slots, so one pass that combines within the
tasks finds them. Of each come SPOTS runs of SPOT_WORDS words spread evenly from its first to its last
word. So that transitions are learned from switches too, training sequences join stretches of different
documents. Everything else runs on whole texts in the tasks.

Forward-backward of a long text runs on stretches side by side: the product of a stretch's transfer
matrices carries the messages across it, which gives what a word by word pass gives.

Defined results: a null text, or one without a letter, has language ``und`` and score 0. A word is a
run without white space that has a letter; others are left out. Repeated rows are predicted alike;
further columns are ignored. Without labelled documents every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles as S
from .store import give_back, packed, read_documents, small_batches, unpacked

UNKNOWN = "und"
TRAIN_DOCS, LEAST_DOCS = 1200, 20
SPOTS, SPOT_WORDS = 6, 20
#: With more labels the matrices of stretches cost more than they save; texts are then passed word by word.
MATRIX_LABELS = 16
BUCKETS = 1 << 17
EPOCHS, RATE, DECAY = 4, 0.3, 1e-6
#: Slots of a worker's table of words that it has met.
CACHE = 1 << 18

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.ones(256, dtype=bool)  # stripped off either end of a word
_PUNCT[65:91] = _PUNCT[97:123] = _PUNCT[128:] = False


def words_of(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end (without marks at the ends) of each word that has a letter."""
    h, owner, start, end = S.word_hashes(raw, at)
    if not len(h):
        return h, owner, start, end
    mark = _PUNCT[raw]
    if mark.any():
        # Nearest position, to either side, that is no mark.
        n = len(raw)
        place = np.arange(n)
        following = np.minimum.accumulate(np.where(mark, n, place)[::-1])[::-1]
        preceding = np.maximum.accumulate(np.where(mark, -1, place))
        new_start, new_end = np.minimum(following[start], end), preceding[end - 1] + 1
        keep = new_end > new_start
        start, end, owner = new_start[keep], new_end[keep], owner[keep]
        low = S._LOWER[raw].astype(np.uint64) + np.uint64(1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low * S.powers(S._BASE, n), dtype=np.uint64)))
        h = S.mix((total[end] - total[start]) * S.powers(S._INVERSE, n)[start] + (end - start).astype(np.uint64))
    return h, owner, start, end


def features(raw: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of the words, one word after another, and where each word's begin."""
    low = S._LOWER[raw].astype(np.uint64)
    n = len(start)
    size = end - start
    grams = np.maximum(size - 2, 0)
    per_word = 1 + 8 + grams
    begin = np.concatenate(([0], np.cumsum(per_word)[:-1]))
    out = np.empty(int(per_word.sum()), np.uint64)
    out[begin] = S.mix(h ^ np.uint64(0x1234567))
    last = max(len(raw) - 1, 0)
    for k in range(4):
        head = np.full(n, 11 + k, np.uint64)
        tail = np.full(n, 21 + k, np.uint64)
        for g in range(k + 1):
            head = head * np.uint64(0x100000001B3) + np.where(g < size, low[np.minimum(start + g, last)], 0).astype(np.uint64)
            tail = tail * np.uint64(0x100000001B3) + np.where(g < size, low[np.maximum(end - 1 - g, 0)], 0).astype(np.uint64)
        out[begin + 1 + k] = S.mix(head)
        out[begin + 5 + k] = S.mix(tail)
    where = np.repeat(begin + 9 - np.concatenate(([0], np.cumsum(grams)[:-1])), grams) + np.arange(int(grams.sum()))
    at = np.repeat(start - np.concatenate(([0], np.cumsum(grams)[:-1])), grams) + np.arange(int(grams.sum()))
    gram = np.full(len(at), 31, np.uint64)
    for g in range(3):
        gram = gram * np.uint64(0x100000001B3) + low[at + g]
    out[where] = S.mix(gram)
    return (out >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), begin


class Chain:
    """Weights of the field: ``state`` (feature, label) and ``move`` (label, next label)."""

    def __init__(self, labels: list[str]) -> None:
        self.labels = labels
        self.state = np.zeros((BUCKETS, len(labels)), np.float32)
        self.move = np.zeros((len(labels), len(labels)))

    def scores(self, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Sum of the weights of each word's features for each label."""
        return np.add.reduceat(self.state[rows], begin, axis=0) if len(begin) else np.zeros((0, len(self.labels)), np.float32)

    def marginals(self, score: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of each label for each word of the texts of ``counts`` words."""
        return self._messages(score, counts)[0]

    def _messages(self, score: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Marginals, forward and backward messages and the words' own potentials, a row a word.

        Stretches of all texts advance together, longest first, so a step handles one word of each.
        """
        k = len(self.labels)
        e = np.exp(score - score.max(axis=1, keepdims=True, initial=-np.inf)).astype(np.float64)
        counts = counts[counts > 0]
        if not len(counts):
            return np.zeros((0, k)), np.zeros((0, k)), np.zeros((0, k)), e
        longest = int(counts.max())
        span = longest if k > MATRIX_LABELS else min(longest, max(8, int(longest**0.5)))
        per_text = -(-counts // span)
        text = np.repeat(np.arange(len(counts)), per_text)
        rank = np.arange(len(text)) - (np.cumsum(per_text) - per_text)[text]  # of the stretch in its text
        begin = (np.cumsum(counts) - counts)[text] + rank * span
        size = np.minimum(counts[text] - rank * span, span)
        order = np.argsort(-size, kind="stable")
        begin, size, opens = begin[order], size[order], rank[order] == 0
        active = np.searchsorted(-size, -np.arange(span), side="left")  # stretches with a word at each step
        m = np.exp(self.move - self.move.max())

        into, after = np.ones((len(text), k)), np.ones((len(text), k))  # messages at the stretches' ends, by stretch
        if (deepest := int(per_text.max())) > 1:
            product = np.repeat(np.eye(k)[None], len(text), axis=0)
            for t in range(span):
                n = active[t]
                p = (product[:n].reshape(n * k, k) @ m).reshape(n, k, k) * e[begin[:n] + t][:, None, :]
                product[:n] = p / p.max(axis=(1, 2), keepdims=True) if t % 8 == 7 else p
            product /= product.max(axis=(1, 2), keepdims=True)
            carry = np.empty_like(product)
            carry[order] = product
            first = np.cumsum(per_text) - per_text
            # The first word of a text has no predecessor: its stretch gets e itself, whatever comes in.
            head = np.empty((len(counts), k))
            head[:] = e[np.cumsum(counts) - counts]
            place = np.empty(len(text), np.int64)
            place[order] = np.arange(len(text))
            lead = first[per_text > 1]
            v = head[per_text > 1]
            where = begin[place[lead]]
            for t in range(1, span):
                v = (v @ m) * e[where + t]
                v /= v.sum(axis=1, keepdims=True)
            into[lead + 1] = v
            for r in range(2, deepest):
                at = first[per_text > r] + r
                v = np.einsum("nk,nkl->nl", into[at - 1], carry[at - 1])
                into[at] = v / v.sum(axis=1, keepdims=True)
            for r in range(deepest - 2, -1, -1):
                at = first[per_text > r + 1] + r
                v = np.einsum("nkl,nl->nk", carry[at + 1], after[at + 1])
                after[at] = v / v.sum(axis=1, keepdims=True)
            into, after = into[order], after[order]
        forward, back = np.empty_like(e), np.empty_like(e)
        a = into
        for t in range(span):
            n = active[t]
            at = begin[:n] + t
            a = a[:n] @ m
            if t == 0:
                a[opens] = 1.0
            a *= e[at]
            a /= a.sum(axis=1, keepdims=True)
            forward[at] = a
        b = np.zeros((0, k))
        for t in range(span - 1, -1, -1):
            n = active[t]
            at = begin[:n] + t
            fresh = after[:n].copy()
            if len(b):
                fresh[: len(b)] = (e[at[: len(b)] + 1] * b) @ m.T
                fresh[: len(b)] /= fresh[: len(b)].sum(axis=1, keepdims=True)
            b = fresh
            back[at] = b
        p = forward * back
        p /= p.sum(axis=1, keepdims=True)
        return p, forward, back, e

    def expectations(self, score: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals, and how often each label is expected to follow each."""
        p, forward, back, e = self._messages(score, counts)
        inner = np.ones(len(score), bool)
        inner[np.cumsum(counts[counts > 0]) - 1] = False
        i = np.flatnonzero(inner)
        pair = forward[i][:, :, None] * np.exp(self.move - self.move.max())[None] * (e[i + 1] * back[i + 1])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        return p, pair.sum(axis=0)

    def fit(self, texts: list[bytes], gold: list[np.ndarray | int], epochs: int = EPOCHS) -> None:
        """Likelihood ascent with per-weight step sizes over minibatches of sequences of labelled words."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        h, owner, start, end = words_of(raw, at)
        y = np.array(gold)[owner]
        rng = np.random.default_rng(5)
        rows, begin = features(raw, h, start, end)
        per_word = np.diff(np.append(begin, len(rows)))
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        seen, seen_move = np.full(self.state.shape, 1e-8, np.float32), np.full(self.move.shape, 1e-8)
        for _ in range(epochs):
            # Stretches of 10 to 60 words, two to four joined to a sequence, so that labels change within some.
            stretches = []
            for t in range(len(texts)):
                w = int(bounds[t])
                while w < bounds[t + 1]:
                    step = int(rng.integers(10, 61))
                    stretches.append((w, min(w + step, int(bounds[t + 1]))))
                    w += step
            rng.shuffle(stretches)
            joined, i = [], 0
            while i < len(stretches):
                take = int(rng.integers(1, 5))
                joined.append(stretches[i : i + take])
                i += take
            for b in range(0, len(joined), 48):
                group = joined[b : b + 48]
                words = np.concatenate([np.arange(x, z) for s in group for x, z in s])
                counts = np.array([sum(z - x for x, z in s) for s in group])
                f = np.repeat(begin[words] - np.concatenate(([0], np.cumsum(per_word[words])[:-1])), per_word[words]) + np.arange(int(per_word[words].sum()))
                local = np.concatenate(([0], np.cumsum(per_word[words])[:-1]))
                p, pair = self.expectations(self.scores(rows[f], local), counts)
                truth = y[words]
                gap = -p
                gap[np.arange(len(words)), truth] += 1
                inner = np.ones(len(words), bool)
                inner[np.cumsum(counts) - 1] = False
                j = np.flatnonzero(inner)
                real = np.zeros_like(self.move)
                np.add.at(real, (truth[j], truth[j + 1]), 1)
                used, inverse = np.unique(rows[f], return_inverse=True)
                grad = np.zeros((len(used), len(self.labels)), np.float32)
                np.add.at(grad, inverse, np.repeat(gap, per_word[words], axis=0).astype(np.float32))
                grad -= DECAY * self.state[used]
                seen[used] += grad * grad
                self.state[used] += RATE * grad / np.sqrt(seen[used])
                step = real - pair - DECAY * self.move
                seen_move += step * step
                self.move += RATE * step / np.sqrt(seen_move)


def train(docs: DataFrame, held_out=None) -> Chain:
    """A field learned from the labelled documents among ``docs`` (doc_id, text, lang)."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if held_out is not None:
        labelled = labelled.where(~held_out)
    h = F.xxhash64("doc_id")
    slots = labelled.groupBy("lang", F.pmod(h, F.lit(TRAIN_DOCS)).alias("slot")).agg(F.min(h).alias("h")).collect()  # TRAIN_DOCS a language at most
    labels = sorted({r["lang"] for r in slots})
    chain = Chain(labels)
    if not labels:
        return chain
    each = max(LEAST_DOCS, -(-TRAIN_DOCS // len(labels)))
    by_label: dict[str, list[int]] = {}
    for r in sorted(slots, key=lambda r: r["h"]):
        if len(mine := by_label.setdefault(r["lang"], [])) < each:
            mine.append(r["h"])
    wanted = docs.sparkSession.createDataFrame([(x, y) for x, ys in by_label.items() for y in ys], "lang string, h long")
    words, step = F.split("text", r"\s+"), F.greatest(F.size(F.split("text", r"\s+")) - SPOT_WORDS, F.lit(0)) / (SPOTS - 1)
    spots = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SPOTS - 1)), lambda i: F.slice(words, 1 + F.floor(i * step).cast("int"), SPOT_WORDS)))
    stretch = F.array_join(F.when(F.size(words) > SPOTS * SPOT_WORDS, spots).otherwise(words), " ")
    few = labelled.select("lang", h.alias("h"), "text").join(F.broadcast(wanted), ["lang", "h"])
    sample = few.select("lang", "h", stretch.alias("text")).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()  # a row for each of ``wanted``
    number = {label: i for i, label in enumerate(labels)}
    sample.sort(key=lambda r: (r["h"], r["lang"]))
    chain.fit([r["text"].encode() for r in sample], [number[r["lang"]] for r in sample])
    return chain


class _Seen:
    """Scores of words that this worker has met, by hash, in a table of fixed size."""

    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        self.key = np.zeros(CACHE, np.uint64)
        self.score = np.zeros((CACHE, len(chain.labels)), np.float32)

    def scores(self, raw: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        slot = (h & np.uint64(CACHE - 1)).astype(np.int64)
        out = self.score[slot]
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            fresh, first, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            w = miss[first]
            got = self.chain.scores(*features(raw, fresh, start[w], end[w]))
            out[miss] = got[inverse]
            self.key[slot[w]], self.score[slot[w]] = fresh, got
        return out


#: Bytes of text whose words are labelled together.
BLOCK = 1 << 19
_HAS_LETTER = r"\p{L}"


def label(texts: pa.Array, chain: Chain, seen: _Seen) -> tuple[np.ndarray, ...]:
    """Number of the likeliest language of each text (one past the last: none), its share, the switches, how
    sure the labels of its words are (mean of each word's largest probability), and the number of words."""
    raw, at = S.text_bytes(texts)
    n, k = len(texts), len(chain.labels)
    best, share, turns, sure, size = np.full(n, k), np.zeros(n), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64)
    if not k:
        return best, share, turns, sure, size
    for i, j in S.blocks(at, BLOCK):
        part = raw[at[i] : at[j]]
        h, owner, start, end = words_of(part, at[i : j + 1] - at[i])
        counts = np.bincount(owner, minlength=j - i)
        rows = np.flatnonzero(counts)
        if not len(rows):
            continue
        p = chain.marginals(seen.scores(part, h, start, end), counts)
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))[rows]
        sums = np.add.reduceat(p, first, axis=0)
        size[i:j] = counts
        sure[i + rows] = np.add.reduceat(p.max(axis=1), first) / counts[rows]
        best[i + rows] = sums.argmax(axis=1)
        share[i + rows] = np.minimum(sums.max(axis=1) / counts[rows], 1.0)
        word = p.argmax(axis=1)
        turn = np.concatenate(([False], (word[1:] != word[:-1]) & (owner[1:] == owner[:-1])))
        turns[i:j] = np.bincount(owner, weights=turn, minlength=j - i)
    return best, share, turns, sure, size


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, lang_pred, score and n_switches (neighbouring words of different languages) of every text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # half a MB a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        seen = _Seen(chain)
        names = np.array([*chain.labels, UNKNOWN], dtype=object)
        for batch in batches:
            best, share, turns, _, _ = label(batch.column("text"), chain, seen)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(share), pa.array(turns)], ["doc_id", "lang_pred", "score", "n_switches"])
        give_back()

    text = F.when(F.col("text").rlike(_HAS_LETTER), F.col("text")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, lang_pred string, score double, n_switches long")


def keep_clear(docs: DataFrame, chain: Chain, least_sure: float, sure_words: int) -> DataFrame:
    """``docs`` without those of unknown language, or whose words' labels are less sure on average.

    A text may mix any number of languages: each word only has to follow one of them surely. The mean counts
    ``sure_words`` sure words beside the text's own, so the fewer they are, the more unsure they have to be.
    Rows are dropped where they are read.
    """
    small_batches(docs.sparkSession)
    rows = packed(docs, ["text"]).select(F.col("text").rlike(_HAS_LETTER).alias("has_letter"), "text", "_row")
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(shared.value)
        for batch in batches:
            letter = batch.column("has_letter").fill_null(False).to_numpy(zero_copy_only=False)
            best, _, _, sure, size = label(batch.column("text"), shared.value, seen)
            clear = (sure * size + sure_words) / (size + sure_words) >= least_sure
            yield batch.select(["_row"]).filter(pa.array(letter & (best < len(shared.value.labels)) & clear))
        give_back()

    return unpacked(rows.mapInArrow(run, rows.select("_row").schema), docs.columns)


def held_out_column():
    """True for the documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text", "lang")
    chain = train(docs, held_out_column())
    return predict(docs, chain).select("doc_id", held_out_column().alias("held_out"), "lang_pred", "score", "n_switches")
