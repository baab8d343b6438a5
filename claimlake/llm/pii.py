"""Personal data in texts by a skip-chain conditional random field over suspect tokens.

Base spans come from patterns (e-mail, IPv4, card and phone numbers with their checks). A field then
labels every token that holds a digit or an at sign; all other tokens are plain by definition and only
serve as context. Base spans are tokens whose label is given. The field's potentials are

* token features: shape, counts of digits, dots and signs, checks such as Luhn, neighbouring words;
* a chain potential between suspect tokens that follow each other;
* a skip potential between each token and the last earlier one in the document with the same
  normalised form (digits and letters alone), however far off, so mentions of one entity get one label;
* another between it and the last earlier similar one: of the same last SUFFIX digits, or whose forms
  are equal when one character of each is struck out (a digit mistyped or left out).

Loopy belief propagation runs on each document's graph, all graphs of a block at once. Tokens that the
field gives a kind with a probability over ADD_ABOVE become spans of their own, without marks at their
ends; neighbours of one kind are one span. Base spans always stay.

The weights, those of skips too, are learned on the driver by pseudo-likelihood from a bounded sample of
TRAIN_DOCS documents with a digit or at sign (the smallest hashes of doc_id within as many slots). Their
base spans serve as labels. As the patterns' own checks would explain these fully, each document is seen
COPIES times more with some spans damaged (a wrong or missing digit or sign, other separators) or mentioned once more,
labelled as before, with ordinary numbers (dates, amounts, versions) among them, and with the checks hidden
from some tokens. Tokens of a span's form that only fail
its check are unlabelled: they may be personal data mistyped. Texts over SPOTS times SPOT_CHARS characters
are learned from by so many stretches from all over them. Finding works on whole texts.

Defined results: a null text counts as empty; a text without spans has empty ``spans``, counts of 0 and
the digest of the empty string. Offsets are in code points, the end exclusive. Repeated rows give equal
rows; further columns are ignored. A token of any length counts whole.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import packed, read_documents, small_batches, unpacked

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0 is plain
TRAIN_DOCS = 600
SPOTS, SPOT_CHARS = 10, 2_000
#: Times that a document with spans is seen with these damaged, each time otherwise.
COPIES = 4
ADD_ABOVE = 0.9
#: Digits at the end that make two numbers similar; forms of so many characters or more that differ in one are, too.
SUFFIX, ALIKE_FROM = 7, 8
ROUNDS = 8
BUCKETS = 1 << 14

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SUSPECT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    """Whether the check digit holds."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each at sign outwards, so in linear time."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            last = found.end()
            out.append((begin, last))
        else:
            last = at + 1
        at = text.find("@", at + 1)
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches that pass their checks, by kind, then start."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(0, s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append((3, *m.span()))
    return out


# ---- tokens and their features

_TRIM = "()[]{}<>,;:!?\"'#$%&*.…"


class Token:
    """A suspect token: place, label of its base span (0: none), normalised form, feature rows; ``gold`` to learn
    from (-1: unlabelled)."""

    __slots__ = ("end", "form", "gold", "label", "rows", "start")


def tokens(text: str, spans: list[tuple[int, int, int]], hide: Callable[[], bool] = lambda: False) -> list[Token]:
    """Suspect tokens in order: runs without white space that hold a digit or at sign; a base span is one token."""
    out: list[Token] = []
    edges: list[tuple[int, int, int]] = []
    reach = 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):  # of spans that overlap, the first
        if s >= reach:
            edges.append((s, e, k + 1))
            reach = e
    at, i = 0, 0
    while m := _SUSPECT.search(text, at):
        p = m.start()
        while i < len(edges) and edges[i][1] <= at:
            i += 1
        if i < len(edges) and edges[i][0] <= p:
            s, e, label = edges[i]
            i += 1
        else:
            stop = edges[i][0] if i < len(edges) else len(text)
            space = _SPACE.search(text, p, stop)
            s, e, label = p, space.start() if space else stop, 0
            while s > at and not text[s - 1].isspace():
                s -= 1
        t = Token()
        t.start, t.end, t.label, t.gold = s, e, label, label
        word = text[s:e]
        t.form = _ODD.sub("", word.lower())
        t.rows = _features(word, text[max(0, s - 24) : s], text[e : e + 24], hide())
        out.append(t)
        at = max(e, p + 1)
    return out


_SPACE, _ODD = re.compile(r"\s"), re.compile(r"[^0-9a-z@]")
_RUNS = [(re.compile(r"[0-9]+"), "9"), (re.compile(r"[A-Z]+"), "A"), (re.compile(r"[a-z]+"), "a")]


def _features(word: str, before: str, after: str, hide_checks: bool) -> list[int]:
    bare = word.strip(_TRIM)
    digits = _digits(bare)
    shape = bare
    for run, letter in _RUNS:
        shape = run.sub(letter, shape)
    dots = bare.split(".") if len(bare) < 64 else []
    names = [
        "bias",
        f"shape={shape if len(shape) < 16 else len(shape) // 8}",
        f"digits={min(len(digits), 20)}",
        f"all={len(digits) == len(bare)},{min(len(bare), 20)}",
        f"at={bare.count('@')}",
        f"dots={min(bare.count('.'), 5)}",
        f"dash={min(bare.count('-'), 4)}",
        f"letters={min(sum(c.isalpha() for c in bare), 6)}",
        f"tail={bare.rpartition('.')[2][:4].lower() if '@' in bare else ''}",
        f"equals={'=' in before[-3:]}",
        f"prev={(before.split() or [''])[-1].lower()}",
        f"next={(after.split() or [''])[0].lower()}",
        f"long={len(bare) > 30}",
        "hidden" if hide_checks else f"plus={word.lstrip('(')[:1] == '+'}",
        "hidden" if hide_checks else f"ip={len(dots) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in dots)}",
        "hidden" if hide_checks else f"luhn={len(digits) > 12 and luhn(digits)},{min(len(digits), 20)}",
    ]
    return [zlib.crc32(x.encode()) & (BUCKETS - 1) for x in names]


# ---- texts to learn from

_LOOSE = re.compile(r"[0-9](?:[ .-]?[0-9]){12,18}|[0-9]+(?:[.,][0-9]+){3}|[0-9(][0-9() .-]{7,}[0-9]|\S*@\S*")


def _damaged(kind: int, span: str, rng: random.Random) -> str:
    """A span as a hasty writer might put it, so that its pattern or check no longer holds as a rule."""
    at = rng.choice([i for i, c in enumerate(span) if c.isdigit()] or [0])
    if kind == 0:
        return span.replace("@", rng.choice([" at ", "(at)", " @ ", "@@"]), 1)
    if kind == 1:
        parts = span.split(".")
        parts[rng.randrange(4)] = str(rng.randint(256, 999))
        return rng.choice([".".join(parts), span.replace(".", ","), span.replace(".", "-")])
    if kind == 2:
        other = str((int(span[at]) + rng.randint(1, 9)) % 10) if span[at].isdigit() else span[at]
        return rng.choice([span[:at] + other + span[at + 1 :], span[:at] + span[at + 1 :], ".".join(re.findall("[0-9]{1,4}", span))])
    return rng.choice([span[1:], "00" + span[1:], span[span.index(" ") + 1 :] if " " in span else span[1:], span[1:].replace(" ", ".")])


def _ordinary(rng: random.Random) -> str:
    """A number that is no personal data."""
    n, day = rng.randrange, f"{rng.randint(1900, 2040)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    return rng.choice(
        [
            str(n(10 ** rng.randint(1, 7))),
            str(rng.randint(1900, 2040)),
            f"{n(10)}.{n(20)}",
            f"v{n(10)}.{n(20)}.{n(30)}",
            f"{n(100)}%",
            f"${n(1000)},{n(1000):03d}.{n(100):02d}",
            f"({n(1000)})",
            f"{n(24)}:{n(60):02d}",
            f"{n(32)}th",
            f"{n(500)}-{n(500)}",
            f"[{n(200)}]",
            day,
            day.replace("-", "/"),
            f"{n(1 << 32):x}{n(1 << 32):x}",
            f"@{rng.choice('abcdef')}{n(100)}",
        ]
    )


def lessons(text: str, rng: random.Random) -> list[list[Token]]:
    """Token lists to learn from: the text as it is, and with spans damaged or mentioned once more."""
    spans = base_spans(text)
    plain = tokens(text, spans, lambda: rng.random() < 0.3)
    for t in plain:
        if not t.label and _LOOSE.search(text, t.start, t.end):
            t.gold = -1
    return [plain, *(_damaged_copy(text, spans, rng) for _ in range(COPIES if spans else 0))]


def _damaged_copy(text: str, spans: list[tuple[int, int, int]], rng: random.Random) -> list[Token]:
    out, gold, at, size = [], [], 0, 0

    def put(piece: str, kind: int | None = None) -> None:
        nonlocal size
        if kind is not None:  # -1: ordinary
            gold.append((size, size + len(piece), kind + 1))
        out.append(piece)
        size += len(piece)

    later: list[tuple[int, str]] = []
    for k, s, e in sorted(spans, key=lambda x: x[1]):
        if s < at:
            continue
        put(text[at:s])
        put(text[s:e] if rng.random() < 0.4 else _damaged(k, text[s:e], rng), k)
        if rng.random() < 0.5:
            later.append((k, rng.choice([text[s:e], _damaged(k, text[s:e], rng)])))
        for _ in range(rng.choice([0, 1, 2])):
            later.append((-1, _ordinary(rng)))
        at = e
    put(text[at:])
    rng.shuffle(later)
    for k, piece in later:
        put(rng.choice([" ", " (", ", "]))
        put(piece, k)
        put(rng.choice([" ", ") ", ". "]))
    again = "".join(out)
    taught = tokens(again, base_spans(again), lambda: rng.random() < 0.3)
    i = 0
    for t in taught:
        while i < len(gold) and gold[i][1] <= t.start:
            i += 1
        if i < len(gold) and gold[i][0] < t.end:
            t.gold = gold[i][2]
        elif not t.label and _LOOSE.search(again, t.start, t.end):
            t.gold = -1
    return taught


# ---- the field

CHAIN, EQUAL, SIMILAR = range(3)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _but_one(form: str) -> list[tuple[int, int]]:
    """Keys of the form without each of its characters in turn, and of all of it as what a longer one leaves.

    Two forms that differ by one character, in place of another or one more, share a key.

    From sums of characters times powers: those before the one left out, and those behind it a power down. So a
    form of any length has as many keys as characters, in a time that grows with their number alone.
    """
    steps = np.full(len(form), _BASE, np.uint64)
    steps[0] = 1
    c = np.array([ord(x) + 1 for x in form], np.uint64) * np.cumprod(steps, dtype=np.uint64)
    before = np.concatenate(([np.uint64(0)], np.cumsum(c, dtype=np.uint64)))
    rest = before[:-1] + (before[-1] - before[1:]) * np.uint64(_INVERSE)
    return [*((len(form), h) for h in rest.tolist()), (len(form) + 1, int(before[-1]))]


class Field:
    """Weights: ``state`` (feature, label), and a matrix (label, label) for each kind of edge."""

    def __init__(self) -> None:
        self.state = np.zeros((BUCKETS, LABELS))
        self.pair = np.zeros((3, LABELS, LABELS))

    @staticmethod
    def edges(docs: list[list[Token]]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of token numbers (over all documents) that share a potential, and the kind of each."""
        pairs, kinds, base = [], [], 0
        for toks in docs:
            last: dict[str | tuple[int, int], int] = {}
            for i, t in enumerate(toks):
                if i:
                    pairs.append((base + i - 1, base + i))
                    kinds.append(CHAIN)
                if (j := last.get(t.form)) is not None:
                    pairs.append((base + j, base + i))
                    kinds.append(EQUAL)
                keys: list[str | tuple[int, int]] = []
                if len(t.form) >= ALIKE_FROM:
                    keys = _but_one(t.form)
                    digits = _digits(t.form)
                    if len(digits) > SUFFIX:
                        keys.append(f"~{digits[-SUFFIX:]}")
                    alike = max((j for key in keys if (j := last.get(key)) is not None and toks[j].form != t.form), default=None)
                    if alike is not None:
                        pairs.append((base + alike, base + i))
                        kinds.append(SIMILAR)
                for key in (t.form, *keys):
                    last[key] = i
            base += len(toks)
        return np.array(pairs, np.int64).reshape(-1, 2), np.array(kinds, np.int64)

    def scores(self, docs: list[list[Token]]) -> np.ndarray:
        """Own potentials, as logarithms; of a base span only its label is possible."""
        rows = [t.rows for toks in docs for t in toks]
        if not rows:
            return np.zeros((0, LABELS))
        out = self.state[np.array(rows)].sum(axis=1)
        given = np.array([t.label for toks in docs for t in toks])
        fixed = np.flatnonzero(given)
        out[fixed] = -50.0
        out[fixed, given[fixed]] = 0.0
        return out

    def marginals(self, docs: list[list[Token]], rounds: int = ROUNDS) -> np.ndarray:
        """Loopy sum-product: messages both ways along every edge, all at once, damped."""
        score = self.scores(docs)
        if not len(score):
            return score
        pairs, kinds = self.edges(docs)
        log_own = score - score.max(axis=1, keepdims=True)
        m = np.exp(self.pair - self.pair.max(axis=(1, 2), keepdims=True))[kinds]
        a, b = pairs.T
        to_b = np.full((len(pairs), LABELS), 1 / LABELS)
        to_a = to_b.copy()

        def belief() -> np.ndarray:
            log = log_own.copy()
            np.add.at(log, b, np.log(to_b + 1e-300))
            np.add.at(log, a, np.log(to_a + 1e-300))
            return log - log.max(axis=1, keepdims=True)

        for _ in range(rounds if len(pairs) else 0):
            log = belief()
            from_a, from_b = log[a] - np.log(to_a + 1e-300), log[b] - np.log(to_b + 1e-300)
            from_a, from_b = (np.exp(x - x.max(axis=1, keepdims=True)) for x in (from_a, from_b))
            new_b, new_a = np.einsum("el,elk->ek", from_a, m), np.einsum("ek,elk->el", from_b, m)
            to_b = 0.5 * to_b + 0.5 * new_b / new_b.sum(axis=1, keepdims=True)
            to_a = 0.5 * to_a + 0.5 * new_a / new_a.sum(axis=1, keepdims=True)
        p = np.exp(belief())
        return p / p.sum(axis=1, keepdims=True)

    def fit(self, docs: list[list[Token]], epochs: int = 80, rate: float = 0.4, decay: float = 0.05) -> None:
        """Pseudo-likelihood: each labelled token given its features and its neighbours' labels."""
        y = np.array([t.gold for toks in docs for t in toks], np.int64)
        known = y >= 0
        if not known.any():
            return
        rows = np.array([t.rows for toks in docs for t in toks])
        pairs, kinds = self.edges(docs)
        a, b = pairs.T
        sure = known[a] & known[b]
        a, b, kinds = a[sure], b[sure], kinds[sure]
        n = int(known.sum())
        seen, seen_pair = np.full(self.state.shape, 1e-6), np.full(self.pair.shape, 1e-6)
        for _ in range(epochs):
            z = self.state[rows].sum(axis=1)
            np.add.at(z, b, self.pair[kinds, y[a]])
            np.add.at(z, a, self.pair[kinds, :, y[b]])
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            gap = -p
            gap[np.flatnonzero(known), y[known]] += 1
            gap[~known] = 0
            gap /= n
            grad = -decay * self.state / n
            for f in range(rows.shape[1]):
                np.add.at(grad, rows[:, f], gap)
            seen += grad * grad
            self.state += rate * grad / np.sqrt(seen)
            g = -decay * self.pair / n
            np.add.at(g, (kinds, y[a]), gap[b])
            np.add.at(g.transpose(0, 2, 1), (kinds, y[b]), gap[a])
            seen_pair += g * g
            self.pair += rate * g / np.sqrt(seen_pair)


def train(docs: DataFrame) -> Field:
    """A field learned from a bounded sample of ``docs`` (doc_id, text)."""
    suspect = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id").alias("h"), "text")
    wanted = suspect.groupBy(F.pmod("h", F.lit(TRAIN_DOCS)).alias("slot")).agg(F.min("h").alias("h")).select("h")  # TRAIN_DOCS rows at most
    step = F.greatest(F.length("text") - SPOT_CHARS, F.lit(0)) / (SPOTS - 1)
    spots = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SPOTS - 1)), lambda i: F.substring(F.col("text"), 1 + F.floor(i * step).cast("int"), F.lit(SPOT_CHARS))), " ")
    text = F.when(F.length("text") > SPOTS * SPOT_CHARS, spots).otherwise(F.col("text"))
    sample = suspect.join(F.broadcast(wanted), "h").select("h", text.alias("text")).groupBy("h").agg(F.min("text").alias("text")).collect()  # a row for each of ``wanted``
    field, rng = Field(), random.Random(7)
    field.fit([toks for r in sorted(sample, key=lambda r: r["h"]) for toks in lessons(r["text"], rng)])
    return field


def _added(text: str, toks: list[Token], p: np.ndarray, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    taken = sorted((s, e) for _, s, e in spans)
    starts = [s for s, _ in taken]
    out: list[tuple[int, int, int]] = []
    for t, q in zip(toks, p, strict=True):
        k = int(q.argmax())
        if t.label or not k or q[k] <= ADD_ABOVE:
            continue
        s, e = t.start, t.end
        while s < e and text[s] in _TRIM:
            s += 1
        while e > s and text[e - 1] in _TRIM:
            e -= 1
        i = bisect.bisect_left(starts, e)
        if s < e and not any(x < e and s < y for x, y in taken[max(0, i - 3) : i + 1]):
            if out and out[-1][0] == k - 1 and len(text[out[-1][2] : s].strip(_TRIM + " ")) == 0 and s - out[-1][2] <= 3 and _one(k - 1, text[out[-1][1] : e]):
                out[-1] = (k - 1, out[-1][1], e)
            else:
                out.append((k - 1, s, e))
    return out


def _one(kind: int, text: str) -> bool:
    """Whether neighbouring pieces may together be one mention of the kind: not more than fits into one."""
    if KINDS[kind] == "email":
        return text.count("@") <= 1
    if KINDS[kind] == "ip":
        return len(re.findall(r"[0-9]+", text)) <= 4
    return len(_digits(text)) <= (19 if KINDS[kind] == "card" else 15)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


_FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Base and added spans of every text."""
    small_batches(docs.sparkSession)
    none = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = len(texts)
            counts, shas, spans, added, every = np.zeros((n, len(KINDS)), np.int64), [none] * n, [""] * n, np.zeros(n, np.int64), np.zeros(n, np.int64)
            some = [i for i, t in enumerate(texts) if t]
            bases = {i: base_spans(texts[i]) for i in some}
            toks = {i: tokens(texts[i], bases[i]) for i in some}
            p = field.marginals([toks[i] for i in some])
            at = 0
            for i in some:
                mine, at = p[at : at + len(toks[i])], at + len(toks[i])
                more = _added(texts[i], toks[i], mine, bases[i])
                for k, _, _ in bases[i]:
                    counts[i, k] += 1
                shas[i] = hashlib.sha256(joined(bases[i]).encode()).hexdigest()
                spans[i], added[i], every[i] = joined(sorted(bases[i] + more)), len(more), len(bases[i]) + len(more)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in counts.T.copy()), pa.array(shas), pa.array(spans), pa.array(added), pa.array(every)], [f.split()[0] for f in _FOUND.split(", ")])

    # Most texts hold neither a digit nor an at sign: they needn't go to Python.
    text = F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, _FOUND)


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with each span in its text replaced by its kind in brackets (of overlapping ones the first).

    Rows are rewritten where they are read, each by its own spans, whatever their doc_id.
    """
    small_batches(docs.sparkSession)
    rows = packed(docs, ["text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            some = [i for i, t in enumerate(texts) if t and _SUSPECT.search(t)]
            bases = {i: base_spans(texts[i]) for i in some}
            toks = {i: tokens(texts[i], bases[i]) for i in some}
            p, n = field.marginals([toks[i] for i in some]), 0
            for i in some:
                text, parts, at = texts[i], [], 0
                more = _added(text, toks[i], p[n : n + len(toks[i])], bases[i])
                n += len(toks[i])
                for s, e, k in sorted((s, e, k) for k, s, e in bases[i] + more):
                    if s >= at:
                        parts += [text[at:s], f"[{KINDS[k]}]"]
                        at = e
                texts[i] = "".join(parts) + text[at:]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("_row")], names=["text", "_row"])

    return unpacked(rows.mapInArrow(run, rows.schema), docs.columns, text=F.col("text"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return find(docs, train(docs))
