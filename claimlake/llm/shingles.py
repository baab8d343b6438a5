"""Word shingles and MinHash signatures over the raw bytes of an Arrow text column.

A text is lower-cased in A-Z only and cut at the bytes for space and tab..carriage return. Word
hashes come from one running polynomial over the whole block, so nothing loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes of text that are hashed together; bounds the working arrays.
BLOCK = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each text; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(at: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes; a longer text has its own."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield i, j
        i = j


def lower(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[raw]


def byte_table(chars: bytes) -> np.ndarray:
    """True for the bytes of ``chars``."""
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


def word_hashes(raw: np.ndarray, at: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end of each word of the texts raw[at[i]:at[i+1]], cut at bytes of ``between``."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    low = _LOWER[raw]
    inside = ~between[low]
    cut = np.zeros(n + 1, dtype=bool)  # a text begins here
    cut[at] = True
    starts = np.flatnonzero(inside & ~(np.concatenate(([False], inside[:-1])) & ~cut[:-1]))
    ends = np.flatnonzero(inside & ~(np.concatenate((inside[1:], [False])) & ~cut[1:])) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
    h = (total[ends] - total[starts]) * powers(_INVERSE, n)[starts]
    h = mix(h + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(at, starts, side="right") - 1, starts, ends


def shingle_hashes(words: np.ndarray, text: np.ndarray, n_texts: int, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in text order and the count of each text.

    A text of fewer words, but at least one, has one shingle: all its words.
    """
    per_text = np.bincount(text, minlength=n_texts)
    first = np.concatenate(([0], np.cumsum(per_text)))[:-1]
    short = (per_text > 0) & (per_text < k)
    counts = np.where(short, 1, np.maximum(per_text - k + 1, 0))
    owner = np.repeat(np.arange(n_texts), counts)
    begin = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.concatenate(([0], np.cumsum(counts)))[:-1], counts)
    size = np.where(short, per_text, k)[owner]
    h = size.astype(np.uint64)
    for i in range(k):
        here = i < size
        part = words[np.minimum(begin + i, max(len(words) - 1, 0))] if len(words) else h[:0]
        h = np.where(here, mix(h * np.uint64(0xD6E8FEB86659FD93) + part), h) if short.any() else mix(h * np.uint64(0xD6E8FEB86659FD93) + part)
    return h, counts


def distinct_per_text(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, one after another, and their counts."""
    out, sizes, a = [], np.zeros(len(counts), np.int64), 0
    for i, c in enumerate(counts):
        if c:
            part = np.sort(h[a : a + c])
            keep = np.ones(c, dtype=bool)
            np.not_equal(part[1:], part[:-1], out=keep[1:])
            part = part[keep]
            out.append(part)
            sizes[i] = len(part)
            a += c
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def permutations(n: int, seed: int = 20240229) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and increments of n universal hash functions modulo 2**64."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(values: np.ndarray, counts: np.ndarray, a: np.ndarray, b: np.ndarray, slice_size: int = 1 << 15) -> np.ndarray:
    """Minimum of a*x+b over each text's values, one column for each function; all ones if it has none."""
    out = np.full((len(counts), len(a)), np.iinfo(np.uint64).max, dtype=np.uint64)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return out
    ends = np.cumsum(counts[rows])
    at = np.concatenate(([0], ends))
    work = np.empty(slice_size, dtype=np.uint64)
    i = 0
    while i < len(rows):
        j = max(i + 1, int(np.searchsorted(at, at[i] + slice_size, side="right")) - 1)
        for lo in range(int(at[i]), int(at[j]), slice_size):  # more than one turn only within a long text
            hi = min(int(at[j]), lo + slice_size)
            x = values[lo:hi]
            t = work[: hi - lo]
            cuts = np.maximum(at[i:j], lo) - lo
            for p in range(len(a)):
                np.multiply(x, a[p], out=t)
                t += b[p]
                low = np.minimum.reduceat(t, cuts)
                out[rows[i:j], p] = np.minimum(out[rows[i:j], p], low)
        i = j
    return out
