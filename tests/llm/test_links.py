"""Links of fingerprints against brute force, where other texts sit in the buckets."""

import random

import numpy as np
import pyarrow as pa

from claimlake.llm import fingerprints, near_dedup, shingles

DOCS = "doc_id long, text string"


def sets_of(texts):
    out = []
    for _, _, values, n in near_dedup.text_sets(pa.array(texts)):
        out += [set(x.tolist()) for x in np.split(values, np.cumsum(n)[:-1])]
    return out


def brute(texts):
    sets, root = sets_of(texts), list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and k / (len(sets[i]) + len(sets[j]) - k) >= 0.75 and root[i] != root[j]:
                lo, hi = sorted((root[i], root[j]))
                root = [lo if r == hi else r for r in root]
    return root


def bands(text):
    row = fingerprints.fingerprint_rows(pa.array([text]))[0]
    return [tuple(row[k : k + fingerprints.BAND]) for k in range(0, fingerprints.SYMBOLS, fingerprints.BAND)]


def hubs(b, c):
    """For each band that b and c share, a short text with the same minima, unlike both."""
    a, add = shingles.permutations(fingerprints.SYMBOLS, seed=97)
    words = b.split()
    raw, at = shingles.text_bytes(pa.array([b]))
    h, _ = shingles.shingle_hashes(*shingles.word_hashes(raw, at)[:2], 1)
    out = []
    for k, (x, y) in enumerate(zip(bands(b), bands(c), strict=True)):
        if x == y:
            first = [int(np.argmin(h * a[p] + add[p])) for p in range(k * fingerprints.BAND, (k + 1) * fingerprints.BAND)]
            tries = (" ".join(w for i in random.Random(t).sample(first, len(first)) for w in words[i : i + 5]) for t in range(50))
            out.append(next(t for t in (f"{t} {t}" for t in tries) if bands(t)[k] == x))
    return out


def test_links_past_a_hub_in_every_bucket(spark):
    b = " ".join(f"w{i}" for i in range(2000))
    c = " ".join(f"w{i}" for i in range(200, 2000))
    texts = [*hubs(b, c), b, c]
    want = brute(texts)
    n = len(texts)
    assert n > 3 and want[-1] == want[-2] == n - 2
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    assert [(r["a"], r["b"]) for r in fingerprints.near_links(df).collect()] == [(n - 2, n - 1)]
    assert {r["doc_id"]: r["near_group"] for r in fingerprints.with_groups(df).collect()} == dict(enumerate(want))


def test_links_with_a_frequent_passage(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} " + " ".join(f"u{k // 2}x{i}" for i in range(40 - 4 * (k % 2))) for k in range(60)]
    texts += [texts[3], "", "Some few words", "some few  words", None]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    want = brute([t or "" for t in texts])
    assert {r["doc_id"]: r["near_group"] for r in fingerprints.with_groups(df).collect()} == dict(enumerate(want))
    root = {r["node"]: r["root"] for r in near_dedup.components(fingerprints.near_links(df).select("a", "b")).collect()}
    assert [root.get(i, i) for i in range(len(texts))] == want


def test_groups_of_null_and_repeated_ids(spark):
    one, two = (" ".join(f"{k}{i}" for i in range(50)) for k in "ab")
    df = spark.createDataFrame([(None, one), (7, one), (7, two), (9, two + " c"), (None, "x y z")], DOCS)
    got = sorted((repr(r["doc_id"]), repr(r["near_group"])) for r in fingerprints.with_groups(df).collect())
    assert got == [("7", "7"), ("7", "7"), ("9", "7"), ("None", "7"), ("None", "None")]
