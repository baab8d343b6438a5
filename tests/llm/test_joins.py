"""Ranked search, collocations, the Jaccard join and the work of near-duplicate groups, against plain computation."""

import collections
import math
import random
import re

import numpy as np
import pytest

from claimlake.llm import collocations, fingerprints, jaccard_join, near_dedup, ranked_search

DOCS = "doc_id long, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- ranked search


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute_search(docs, items, top=10):
    rows = [(d, collections.Counter(terms_of(t))) for d, t in docs]
    rows = [(d, c) for d, c in rows if c]
    n_docs, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = collections.Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for place, (d, c) in enumerate(rows):
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, place))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d, _) in enumerate(sorted(scored)[:top], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize(("shard", "together"), [(8192, 64), (5, 2)])
def test_ranked_search_equals_brute_force(spark, monkeypatch, shard, together):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked_search, "ITEMS_TOGETHER", together)
    r = random.Random(1)
    words = [f"w{int(r.paretovariate(0.6))}" for _ in range(400)] + ["Éa", "x_y", "日本", "A1"]
    docs = [(r.choice([i, i, i, None, 3]), " ".join(r.choices(words, k=r.choice([1, 5, 40, 400])))) for i in range(90)]
    docs += [docs[0], docs[0], (200, None), (201, ""), (202, "?!"), (203, "w1")]
    items = [(i, " ".join(r.choices(words, k=r.choice([1, 3, 12])))) for i in range(12)] + [(3, "w1 w2"), (None, "w1 W1 w3"), (50, None), (51, "--"), (52, "unseen"), (53, "日本")]
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    got = ranked_search.search(df, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(repr, map(tuple, got.collect()))) == brute_search(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_ranked_search_in_blocks_and_edges(spark, monkeypatch):
    r = random.Random(2)
    docs = [(i, " ".join(r.choices([f"a{k}" for k in range(60)], k=30))) for i in range(40)]
    items = [(i, " ".join(r.choices([f"a{k}" for k in range(60)], k=6))) for i in range(20)]
    df, asked = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 30)
    assert sorted(map(repr, map(tuple, ranked_search.search(df, asked).collect()))) == brute_search(docs, items)
    assert ranked_search.search(df.limit(0), asked).count() == 0
    assert ranked_search.search(df, asked.limit(0)).count() == 0


# ---- collocations


def brute_collocations(rows, least, top=2000):
    f = collections.defaultdict(collections.Counter)
    n = collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("shards", "together"), [(1, 1 << 20), (3, 50), (5, 1 << 20)])
def test_collocations_equal_brute_force(spark, monkeypatch, shards, together):
    """Any number of shards, and tasks that count few words together; thresholds reached early and late in the cycle."""
    monkeypatch.setattr(collocations, "SHARDS", shards)
    monkeypatch.setattr(collocations, "TOGETHER", together)
    monkeypatch.setattr(collocations, "MIN_COUNT", 4)
    monkeypatch.setattr(collocations, "BITS", 8)  # so few that they let much through
    r = random.Random(7)
    rows = []
    for _ in range(90):
        parts = [r.choice(["Of the", "new york", "in new york city", "é x,y", "a b c d e", "to\tbe", "no\x0bway", "z"]) for _ in range(r.randrange(0, 9))]
        rows.append((r.choice([". ", " ", "\n", " , "]).join(parts), r.choice(["en", "en", "fr", None, "und"])))
    rows += [(None, "en"), ("", None), (rows[0][0], rows[0][1]), (rows[0][0], rows[0][1])]
    df = spark.createDataFrame([(i % 50, t, lang) for i, (t, lang) in enumerate(rows)], DOCS + ", lang string").repartition(3)
    monkeypatch.setattr(collocations, "frequent", lambda run, docs, f=collocations.frequent: f(run, docs, 4))
    got = collocations.collocations(df)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 4)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([(1, "a few words", "en"), (2, None, None)], DOCS + ", lang string")
    assert collocations.collocations(df).count() == 0 and collocations.collocations(df.limit(0)).count() == 0


# ---- Jaccard join


def brute_components(rows, k=4, percent=85):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, x in enumerate(sets):
        for j in range(i):
            o = len(x & sets[j])
            if o and 100 * o >= percent * (len(x) + len(sets[j]) - o):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(map(repr, ((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))))


def variants(r, words, n, changes, tag):
    out = []
    for v in range(n):
        w = list(words)
        for i in r.sample(range(len(w)), changes):
            w[i] = f"{tag}{v}_{i}"
        out.append(" ".join(w))
    return out


def test_jaccard_join_equals_brute_force(spark, monkeypatch):
    for name, value in (("FEW_CLASSES", 0), ("PER_PART", 5)):
        monkeypatch.setattr(near_dedup, name, value)
    monkeypatch.setattr(jaccard_join, "PER_TREE", 7)
    r = random.Random(3)
    texts = []
    for b in range(5):
        base = [f"b{b}w{i}" for i in range(r.choice([30, 80, 250]))]
        for changes in (0, 0, 1, 1, 2, len(base) // 30, len(base) // 20):
            texts += variants(r, base, 5, changes, f"m{b}{changes}_")
        texts.append(" ".join(base[:-1]))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"u{k}x{i}" for i in range(40)) for k in range(20)]
    texts += ["a b c", "a b c d", "a b", "A B", None, "", " ", "a b c d e f g h i", "a b c d e f g h i j", "a a a a a a a"]
    r.shuffle(texts)
    rows = [(None if i % 17 == 0 else i % 150, t) for i, t in enumerate(texts)]
    got = jaccard_join.components(spark.createDataFrame(rows, DOCS).repartition(4))
    assert sorted(map(repr, map(tuple, got.collect()))) == brute_components(rows)
    assert jaccard_join.components(spark.createDataFrame([], DOCS)).count() == 0


def test_prefix_tree_equals_plain_comparison():
    r = random.Random(5)
    paths = [np.array(sorted(r.sample(range(40), r.randrange(1, 25)))) for _ in range(60)]
    paths += [paths[0], paths[1][:-1], np.arange(40)]
    sizes = [len(p) + r.randrange(3) for p in paths]
    for q in (*range(0, 63, 5), 62):
        got = sorted(jaccard_join.PrefixTree(paths, sizes).walk(paths[q], sizes[q]))
        common = [len(set(paths[q].tolist()) & set(p.tolist())) for p in paths]
        assert got == [(i, c) for i, c in enumerate(common) if 100 * c >= 85 * (sizes[q] + sizes[i] - c)]
    assert list(jaccard_join.PrefixTree([], []).walk(paths[0], 5)) == []


# ---- work on a star of variants


@pytest.mark.parametrize("origin", [-1, 10**6, 400])
@pytest.mark.parametrize("operator", [near_dedup.groups, fingerprints.near_groups, jaccard_join.components])
def test_a_star_makes_few_pairs_whatever_its_numbers(spark, monkeypatch, origin, operator):
    """One text and 800 variants that are linked with it, but not with each other: at most ten pairs a text are looked at."""
    if operator is jaccard_join.components:
        words, changes = [f"w{i}" for i in range(400)], 5
    else:
        words, changes = [f"w{i}" for i in range(200)], 5
    texts = variants(random.Random(4), words, 800, changes, "v")
    rows = [(i if i < origin or origin < 0 else i + 1, t) for i, t in enumerate(texts)] + [(origin, " ".join(words))]
    looked: list[int] = []
    for module, name in ((near_dedup, "confirmed"), (jaccard_join, "tree_links")):
        real = getattr(module, name)

        def counted(run, *args, real=real):
            pairs = run.table(args[-1], "counted")
            looked.append(pairs.count())
            return real(run, *args[:-1], pairs)

        monkeypatch.setattr(module, name, counted)
    out = operator(spark.createDataFrame(rows, DOCS).repartition(4))
    column = "near_group" if operator is fingerprints.near_groups else "component_id"
    assert [r[0] for r in out.select(column).distinct().collect()] == [min(d for d, _ in rows)] and out.count() == 801
    assert sum(looked) <= 10 * 801
