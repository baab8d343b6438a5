"""The operators against brute force, exact round trips and edge cases, on small frames and the smallest tables."""

import collections
import functools
import hashlib
import re
import struct
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from claimlake.llm import chat_format, decontaminate, fingerprints, language_id, licenses, line_dedup, near_dedup, packing, pii, queries, shingles, store, token_files, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def word_set(text):
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def frame(spark, texts, lang="en", sites=3):
    return spark.createDataFrame([(i, t, lang, f"s{i % sites}", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return store.read_documents(spark, sf_dir)


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def test_shingles_match_plain_python():
    texts = ["", "One two", "A b C d e F", "x  y\tz\nw v u t", "é ü ß a b c", " lead and trail "]
    raw, at = shingles.text_bytes(pa.array(texts))
    h, owner, _, _ = shingles.word_hashes(raw, at)
    values, n = shingles.distinct_per_text(*shingles.shingle_hashes(h, owner, len(texts)))
    assert n.tolist() == [len(word_set(t)) for t in texts]


def brute_components(texts):
    sets = {d: word_set(t) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_dedup_equals_brute_force(spark, docs, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.groups(docs).collect()}
    assert got == brute_components(texts)


def test_near_dedup_chain_and_edges(spark):
    words = [f"w{i}" for i in range(60)]
    chain = [" ".join(words[i : i + 40]) for i in range(0, 16, 3)]  # each like the next, the ends unlike each other
    shared = " ".join(f"p{i}" for i in range(50))
    passages = [shared + " " + " ".join(f"u{k}x{i}" for i in range(40)) for k in range(30)]
    texts = [None, "", "  \n ", "one two", "ONE  two", "one two three", *chain, *passages, passages[0]]
    df = frame(spark, texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.groups(df).collect()}
    assert got == brute_components(dict(enumerate(texts)))
    kept = near_dedup.deduplicate(df)
    assert kept.columns == df.columns and kept.count() == len({c for _, c in got.values()})
    assert near_dedup.groups(df.limit(0)).count() == 0


def test_near_dedup_of_null_and_repeated_ids(spark):
    one, two, three = (" ".join(f"{k}{i}" for i in range(50)) for k in "abc")
    rows = [(None, one), (7, one), (7, one), (7, two), (9, two + " c"), (None, three), (None, three), (4, None), (4, None), (None, ""), (5, "x " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", F.lit("r"))
    got = sorted(repr(tuple(r)) for r in near_dedup.groups(df).collect())
    a, t, b = 46, 46, 47
    assert got == sorted(map(repr, [(None, a, 7, False), (7, a, 7, True), (7, a, 7, True), (7, t, 7, True), (9, b, 7, False), (None, t, None, True), (None, t, None, True), (4, 0, 4, True), (4, 0, 4, True), (None, 0, None, True), (5, 1, 5, True)]))
    kept = sorted(repr((r["doc_id"], r["text"] and r["text"][:2])) for r in near_dedup.deduplicate(df).collect())
    assert kept == sorted(map(repr, [(7, "a0"), (7, "b0"), (None, "c0"), (4, None), (4, None), (None, ""), (5, "x ")]))
    assert near_dedup.deduplicate(df).columns == df.columns


def test_near_dedup_with_a_large_component_and_outsiders(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PER_PART", 5)
    monkeypatch.setattr(near_dedup, "FEW_CLASSES", 0)
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(base[:20] + [f"n{k}"] + base[21:]) for k in range(40)]
    other = [" ".join(base[:12] + [f"o{k}x{i}" for i in range(30)]) for k in range(20)]
    twins = [" ".join([*base[:8], *(f"t{k // 2}y{i}" for i in range(36 + k % 2))]) for k in range(20)]
    texts = dict(enumerate([*near, *other, *twins]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.groups(frame(spark, list(texts.values()))).collect()}
    assert got == brute_components(texts)


def test_runs_leave_only_their_result(spark, docs):
    import pathlib

    folder = pathlib.Path(store.shared_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    near_dedup.groups(docs.where("doc_id < 60")).count()
    (made,) = set(folder.iterdir()) - before
    assert [p.name.split("-")[0] for p in made.iterdir()] == ["result"]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r["node"]: r["root"] for r in near_dedup.components(edges).collect()}
    assert {got[i] for i in range(1, 41)} == {0} and got[101] == 100


def test_fingerprints(spark, docs, texts):
    got = {r["doc_id"]: r for r in fingerprints.edited_likeness(docs).collect()}
    order = sorted(texts, reverse=True)
    seen = {}
    for k, d in enumerate(order):
        t, n = texts[d] or "", texts[order[(k + 1) % len(order)]] or ""
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert (got[d]["n_chars"], got[d]["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert seen.setdefault(t, got[d]["fingerprint"]) == got[d]["fingerprint"]
    long = [r for r in got.values() if r["n_chars"] > 200]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.95
    assert abs(np.mean([r["near_edited"] for r in long]) - 1 / 3) < 0.05


def test_fingerprints_are_minima_of_universal_hashes(texts):
    some = [t or "" for t in list(texts.values())[:40]] + ["", "two words", "one two three four five"]
    a, b = (x.tolist() for x in shingles.permutations(fingerprints.SYMBOLS, seed=97))
    rows = fingerprints.fingerprint_rows(pa.array(some))
    sets = [v for _, _, values, n in near_dedup.text_sets(pa.array(some)) for v in np.split(values, np.cumsum(n)[:-1])]
    for row, values in zip(rows.tolist(), sets, strict=True):
        for p in range(0, fingerprints.SYMBOLS, 9):
            low = min(((a[p] * int(v) + b[p]) % 2**64 for v in values), default=2**64 - 1)
            assert row[p] == int(shingles.mix(np.array([low], np.uint64))[0]) >> 48


@pytest.mark.parametrize("n", [4, 5, 29, 30])
def test_likeness_has_no_step_at_any_length(n):
    w = [f"w{i}" for i in range(n + 1)]
    a, b = fingerprints.fingerprint_rows(pa.array([" ".join(w[:n]), " ".join(w)]))
    true = len(word_set(" ".join(w[:n])) & word_set(" ".join(w))) / len(word_set(" ".join(w[:n])) | word_set(" ".join(w)))
    assert abs((a == b).mean() - true) < 0.2


def test_links_recall_against_brute_force(spark, docs, texts):
    sets = {d: word_set(t) for d, t in texts.items()}
    want = brute_components(texts)
    got = {r["doc_id"]: r["near_group"] for r in fingerprints.with_groups(docs).collect()}
    linked = [d for d, (_, c) in want.items() if c != d and sets[d]]
    assert linked and np.mean([got[d] == want[d][1] for d in linked]) >= 0.97
    assert all(want[d][1] == want[got[d]][1] for d in got)  # nothing is linked that isn't


def test_fingerprint_edges_and_links(spark):
    df = frame(spark, [None, "", "ab", "same words in both of these texts here", "same words in both of these texts here"])
    assert {r["doc_id"]: r["n_chars"] for r in fingerprints.edited_likeness(df).collect()}[0] == 0
    one = fingerprints.edited_likeness(df.where("doc_id = 2")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"aa").hexdigest() and one["near_next"] == 1.0
    assert [(r["a"], r["b"], r["jaccard"]) for r in fingerprints.near_links(df.where("doc_id > 1")).collect()] == [(3, 4, 1.0)]
    assert fingerprints.edited_likeness(df.limit(0)).count() == 0


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def plain_ids(text):
    return np.array(library().encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check_encoder(own, every, ids_of=plain_ids):
    for k in range(0, len(every), 20):
        some = every[k : k + 20]
        for i, j, ids, n in own.encode(pa.array(some, pa.large_string())):
            ends = np.cumsum(n)
            for t, a, b in zip(some[i:j], ends - n, ends, strict=True):
                assert ids[a:b].tolist() == ids_of(t).tolist(), repr(t)


def test_encoder_equals_the_library(texts, monkeypatch):
    import random

    odd = ["", " ", "  ", "a  b", "a \n b", "x\t\ty ", "it's, ok. No.\nYes", "a.,b ., c", "<|endoftext|> x", "hello <|endoftext|> world", "\x01 a", "12 ab12, é. ß\n", "a  b", "\n\n", "a\n", "'sx 'lll x'res", "a\u00a0 b \u2003\n\nc\x85d\x1c e", "”q’s —x", None]
    own = tokens.Encoder(tokens.default_tokenizer())
    every = odd + [t or "" for t in list(texts.values())[:60]] + odd
    check_encoder(own, every)
    random.seed(3)
    parts = [" ", " ", "\n", "\t", "a", "ab", "the", "Z", "7", "42", ",", "'", "'s", "'ll", ".", "é", "ß", "—", "\u00a0", "\u3000", "漢", "🙂", "<|endoftext|>", "-", "\r", "\x0b"]
    check_encoder(own, ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(6000)])
    monkeypatch.setattr(tokens, "SLICE", 300)
    monkeypatch.setattr(tokens, "POOL", 2000)
    monkeypatch.setattr(tokens, "SLOTS", 64)
    check_encoder(tokens.Encoder(tokens.default_tokenizer()), ["word " * 900 + "x" * 700 + " \n y", *every])


def test_encoder_of_another_kind_of_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    check_encoder(tokens.Encoder(path), ["Some Words, here", "", "a  b"], lambda t: np.array(other.encode(t, add_special_tokens=False).ids + [0], "<u4"))


def test_token_files_round_trip(spark, docs, texts):
    folder = store.new_path(spark, "tokens")
    manifest = token_files.write_files(docs, folder, tokens.default_tokenizer(), per_file=40)
    got = token_files.read_files(manifest, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted(texts) and manifest.count() > 2
    at = 0
    for r in got:
        ids = plain_ids(texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    wanted = token_files.read_files(manifest, folder).where("doc_id = 7").select("file", "frame")
    assert [bytes(r["ids"]) for r in token_files.fetch(manifest, folder, wanted).collect()] == [plain_ids(texts[7]).tobytes()]
    name = manifest.orderBy("range_no", "part").first()["file"]
    data = open(name, "rb").read()
    n, flag, magic = struct.unpack("<IBI", data[-9:])
    assert (flag, magic) == (0x80, 0x8F92EAB1) and n <= 160
    sizes = np.frombuffer(data[-9 - 12 * n : -9], "<u4").reshape(n, 3)
    assert zstandard.ZstdDecompressor().decompress(data[: sizes[0, 0]], max_output_size=int(sizes[0, 1])) == plain_ids(texts[min(texts)]).tobytes()
    at = int(sizes[:, 0].sum())
    assert struct.unpack("<I", data[at : at + 4])[0] == token_files.IDS_MAGIC
    broken = bytearray(data)
    broken[12] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.FrameFile(pa.BufferReader(bytes(broken))).raw(0)


def test_token_file_edges(spark):
    big = spark.createDataFrame([(2**60 + i, "x") for i in range(40)] + [(None, "y")], "doc_id long, text string")
    folder = store.new_path(spark, "tokens")
    order = token_files.read_files(token_files.write_files(big, folder, tokens.default_tokenizer(), per_file=5), folder).orderBy("start").collect()
    assert [r["doc_id"] for r in order] == [None, *(2**60 + i for i in range(40))]
    df = frame(spark, [None, "", "a b"]).withColumn("start", F.lit(9))
    folder = store.new_path(spark, "tokens")
    got = token_files.read_files(token_files.write_files(df, folder, tokens.default_tokenizer()), folder).orderBy("doc_id").collect()
    assert [(r["start"], r["n_tokens"]) for r in got] == [(0, 1), (1, 1), (2, 3)]
    assert token_files.write_files(df.limit(0), store.new_path(spark, "tokens"), tokens.default_tokenizer()).count() == 0


def test_plan_places_everything_and_is_tight():
    rng = np.random.default_rng(0)
    for lengths in (np.clip(rng.lognormal(6, 1, 20000).astype(int), 1, 2048), rng.integers(1, 2049, 5000), np.full(50, 1025), np.array([700, 700, 600, 5, 2048, 1]), np.array([], int)):
        counts = collections.Counter(lengths.tolist())
        plan = packing.Plan(counts)
        got = collections.Counter()
        for row, n in plan.runs:
            assert sum(row) <= 2048
            for s in row:
                got[s] += n
        assert got == counts
        if len(lengths) >= 5000:
            assert plan.n_sequences <= 1.02 * -(-lengths.sum() // 2048)
    assert packing.Plan({1025: 50}).n_sequences == 50


def test_plan_says_when_it_stops_early(monkeypatch):
    monkeypatch.setattr(packing, "TURNS", 0)
    with pytest.warns(RuntimeWarning):
        assert packing.Plan({1000: 5, 900: 5, 700: 3}).n_sequences >= 6


def test_packing(spark, docs, texts):
    placed = packing.pack(docs, tokens.default_tokenizer())
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in placed.collect():
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = 0
    for d, t in texts.items():
        ids, at = plain_ids(t), 0
        total += len(ids)
        for i, r in enumerate(sorted(by_doc[d], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert i == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids)
    assert len(by_sequence) <= 1.02 * -(-total // 2048) + 1
    some = docs.where("doc_id < 5")
    small = packing.pack(some, tokens.default_tokenizer())
    rows = packing.sequences(some, small, tokens.default_tokenizer()).collect()
    assert sum(len(r["ids"]) // 4 for r in rows) == sum(len(plain_ids(texts[d])) for d in range(5))
    assert packing.pack(docs.limit(0), tokens.default_tokenizer()).count() == 0


def test_language_id_on_held_out_rows(spark, docs, sf_dir):
    got = queries.QUERIES["op2_language_id"](spark, sf_dir)
    right = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.95
    ids = [r["doc_id"] for r in got.where("held_out").select("doc_id").collect()]
    assert ids and all(zlib.crc32(str(d).encode()) % 4 == 2 for d in ids)


def test_language_id_edges_and_switches(spark, docs, texts):
    chain = language_id.train(docs)
    by_lang = {r["lang"]: r["text"] for r in docs.where("length(text) between 500 and 3000").groupBy("lang").agg(F.max("text").alias("text")).collect()}
    half = by_lang["en"][:400] + " " + by_lang["fr"][:200]
    got = {r["doc_id"]: r for r in language_id.predict(frame(spark, [None, "", "123 $$ 4", "× € 5", half, "the of and " * 3000]), chain).collect()}
    assert [got[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and got[0]["score"] == 0.0
    assert got[4]["lang_pred"] == "en" and 0.4 < got[4]["score"] < 0.95 and got[4]["n_switches"] >= 1
    assert got[5]["lang_pred"] == "en"
    mixed = " ".join(t[:300] for t in by_lang.values())  # as much of each of four languages
    junk = " ".join(hashlib.md5(bytes([i])).hexdigest().translate({48: "q", 49: "x", 50: "z", 101: "k"}) for i in range(100))
    clear = language_id.keep_clear(frame(spark, [None, "", "12", half, mixed, junk, "Odd"]).withColumn("score", F.lit(1)), chain, 0.75, 10)
    assert [r["doc_id"] for r in clear.collect()] == [3, 4, 6] and clear.columns[-1] == "score"
    of = [" ".join(junk.split()[:n]) for n in range(1, 41)]  # the fewer words, the more unsure; no step
    left = {r["doc_id"] for r in language_id.keep_clear(frame(spark, of), chain, 0.75, 10).collect()}
    assert 0 in left and 39 not in left
    assert language_id.predict(frame(spark, ["a"]), language_id.train(docs.limit(0))).first()["lang_pred"] == "und"


def test_forward_backward_equals_enumeration():
    import itertools

    c = language_id.Chain(["a", "b"])
    c.move = np.array([[0.5, -0.2], [0.1, 0.3]])
    s = np.random.default_rng(1).normal(size=(7, 2))
    p, pair = c.expectations(s, np.array([3, 0, 4]))
    assert np.isclose(pair.sum(), 5)
    at = 0
    for n in (3, 4):
        want = np.zeros((n, 2))
        for y in itertools.product(range(2), repeat=n):
            w = np.exp(sum(s[at + i, y[i]] for i in range(n)) + sum(c.move[y[i], y[i + 1]] for i in range(n - 1)))
            for i in range(n):
                want[i, y[i]] += w
        assert np.allclose(p[at : at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_stretches_equal_one_pass(monkeypatch):
    rng = np.random.default_rng(0)
    c = language_id.Chain(list("abcd"))
    c.move = rng.normal(size=(4, 4))
    counts = np.array([3, 0, 500, 1, 8, 9, 16, 17, 2000, 64])
    s = 3 * rng.normal(size=(counts.sum(), 4))
    by_stretch = c.marginals(s, counts)
    monkeypatch.setattr(language_id, "MATRIX_LABELS", 1)
    assert np.allclose(by_stretch, c.marginals(s, counts), atol=1e-12)


def test_language_id_learns_every_label_and_the_whole_text(spark):
    name = lambda i: "abcdefghijklmnopqrstuvwxyz"[i // 26] + "abcdefghijklmnopqrstuvwxyz"[i % 26]
    rows = [(100 * i + j, " ".join(f"{name(i)}q{name(j)}{name(i)}" for _ in range(12)), name(i)) for i in range(70) for j in range(4)]
    rows += [(7, "zzz zz zzzz", "zz")] * 3000 + [(8, "zzz zzzz z", "zz")]
    rows += [(9000 + j, "the end " * 100 + f"yyv yv{j} " * 400, "yv") for j in range(4)]  # its own words come late
    chain = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(chain.labels) == 72
    ask = frame(spark, [r[1] for r in rows[:280:7]] + ["zzz zz", "yyv yv1 yyv"])
    got = [r["lang_pred"] for r in language_id.predict(ask, chain).orderBy("doc_id").collect()]
    assert np.mean([a == r[2] for a, r in zip(got, rows[:280:7])]) > 0.9 and got[-2:] == ["zz", "yv"]


def brute_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def test_pii_base_spans(spark, docs, texts):
    import random

    random.seed(1)
    parts = ["@", ".", "1", "255", "300", "+", "a", "b.c", " ", "-", "4111111111111111", "(", "%", "x@y.z", "é", "\n", "+49 123 4567"]
    for _ in range(5000):
        t = "".join(random.choices(parts, k=random.randint(0, 14)))
        assert pii.base_spans(t) == brute_spans(t), t
    for r in pii.find(docs, pii.train(docs)).collect():
        want = brute_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert set(filter(None, pii.joined(want).split(","))) <= set(r["spans"].split(","))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for k, _, _ in want) for i in range(4)]


def labelled(text, gold=()):
    return pii.tokens(text, brute_spans(text))


def test_pii_skip_edges_agree_and_edges(spark):
    field = pii.Field()
    field.pair[pii.EQUAL] = field.pair[pii.SIMILAR] = 4 * np.eye(pii.LABELS)
    text = "call 5551234567 now. " + "word " * 50 + "or +5551234567 there, not 5551234568, 15551234567"
    toks = labelled(text)
    assert [t.form for t in toks] == ["5551234567", "5551234567", "5551234568", "15551234567"] and [t.label for t in toks] == [0, 4, 0, 0]
    pairs, kinds = field.edges([toks])
    assert {(a, b, k) for (a, b), k in zip(pairs.tolist(), kinds.tolist(), strict=True) if k != pii.CHAIN} == {(0, 1, pii.EQUAL), (1, 2, pii.SIMILAR), (1, 3, pii.SIMILAR)} or {(0, 1, pii.EQUAL), (1, 2, pii.SIMILAR), (2, 3, pii.SIMILAR)}
    p = field.marginals([toks])
    assert p[1, 4] > 0.99 and (p[[0, 2, 3]].argmax(axis=1) == 4).all()  # far mentions take the label of the pattern's span
    df = frame(spark, [None, "", "a@b.co and 1.2.3.4", "no data here", "x" * 500 + "1 " + "x" * 500 + "2"])
    found = pii.find(df, pii.Field())
    got = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert got == {0: "", 1: "", 2: "email:0:6,ip:11:18", 3: "", 4: ""}
    assert {r["doc_id"]: r["text"] for r in pii.redact(df, pii.Field()).collect()}[2] == "[email] and [ip]"
    assert pii.find(df.limit(0), pii.Field()).count() == 0
    assert pii.base_spans("a" * 50000 + "@" + "1." * 50000) is not None


def test_pii_skip_edges_reach_forms_of_any_length():
    for size in (3, 5, 8, 40, 41, 200):
        form = "".join("0123456789abcdef"[i * 7 % 16] for i in range(size))
        changed = form[: size // 2] + "z" + form[size // 2 + 1 :]
        shorter = form[:-1]
        for other, kind in ((form, pii.EQUAL), (changed, pii.SIMILAR), (shorter, pii.SIMILAR)):
            text = f"{form} then {other}1" if other == form else f"{form} then {other}"
            text = f"{form} then {other}" if other != form else f"{form} then {form}"
            pairs, kinds = pii.Field.edges([pii.tokens(text, [])])
            if kind == pii.EQUAL or size >= pii.ALIKE_FROM + 1:
                assert kind in kinds.tolist(), (size, other)


def test_pii_neighbours_join_only_to_what_fits():
    assert not pii._one(2, "4465758382889437 4465758382889437") and pii._one(2, "4465 7583 8288 9437")
    assert not pii._one(0, "a@b.c d@e.f") and pii._one(1, "1.2.3 .4") and not pii._one(1, "1.2.3.4 5.6.7.8")


def test_pii_redaction_by_row(spark, docs):
    field = pii.train(docs)
    df = spark.createDataFrame([(None, "to a@b.com"), (1, "card 4111111111111111 x"), (1, "no"), (2, None), (1, "card 4111111111111111 x")], "doc_id long, text string").withColumn("a.b", F.lit("k"))
    out = pii.redact(df, field)
    assert out.columns == df.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect()) == sorted([("None", "to [email]"), ("1", "card [card] x"), ("1", "no"), ("2", "None"), ("1", "card [card] x")])


def test_pii_long_tokens_with_one_head_are_apart():
    a, b = labelled("7" * 450 + "x1 " + "7" * 450 + "y2")
    assert a.form != b.form and not [k for k in pii.Field.edges([[a, b]])[1] if k != pii.CHAIN]


def test_pii_messages_equal_exact_inference_on_trees():
    import itertools

    rng = np.random.default_rng(4)
    field = pii.Field()
    field.pair[:] = rng.normal(size=field.pair.shape)
    toks = labelled("1a 22 then 333 at 4b4")
    for i, t in enumerate(toks):
        t.rows = [i + 1]
        field.state[i + 1] = rng.normal(size=pii.LABELS)
    pairs, kinds = field.edges([toks])
    want = np.zeros((len(toks), pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=len(toks)):
        w = np.exp(sum(field.state[i + 1, k] for i, k in enumerate(y)) + sum(field.pair[kind, y[a], y[b]] for (a, b), kind in zip(pairs, kinds, strict=True)))
        for i, k in enumerate(y):
            want[i, k] += w
    assert np.allclose(field.marginals([toks], rounds=80), want / want.sum(axis=1, keepdims=True), atol=1e-6)


def test_pii_finds_damaged_mentions(spark):
    """Learned on a table of a thousand documents, held against spans that were damaged in made up ones."""
    import random

    field = pii.train(store.read_documents(spark, "/root/testdata/sf0.01"))
    assert all(field.pair[k].trace() > field.pair[k].sum() - field.pair[k].trace() for k in (pii.EQUAL, pii.SIMILAR))
    rng, right, wrong, missed = random.Random(5), 0, 0, 0
    for k in range(150):
        card = f"{rng.randrange(10**15):015d}"
        card += next(c for c in "0123456789" if pii.luhn(card + c))
        data = [f"a.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)), card, f"+1 ({rng.randint(100, 999)}) 555-{rng.randrange(10000):04d}"]
        filler = rng.sample([f"v{rng.randrange(9)}.{rng.randrange(9)}", f"{rng.randrange(1000)}", f"in {rng.randint(1900, 2030)}", f"{rng.randrange(99)}%", "4th"], 3)
        text = " and ".join(rng.sample([data[k % 4], data[(k + 1) % 4], *filler], 5))
        for learned in pii.lessons(text, rng)[1:]:
            p = field.marginals([learned])
            for t, q in zip(learned, p, strict=True):
                if not t.label and t.gold >= 0:
                    says = int(q.argmax()) if q.max() > pii.ADD_ABOVE else 0
                    right, wrong, missed = right + (says == t.gold > 0), wrong + (says > 0 and says != t.gold), missed + (says == 0 < t.gold)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.5


def test_decontamination(spark, docs, texts, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r["item_id"]: decontaminate.normal(r["text"]) for r in bench.collect()}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.hits(docs, bench).collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x in decontaminate.normal(t)}
    assert exact and {k for k, v in got.items() if v == 0} == exact
    item = items[0]
    edited = list(item)
    for i in range(5, len(item), max(15, len(item) // max(1, decontaminate.budget(len(item)) - 1))):
        edited[i] = "q"
    df = frame(spark, [None, "", "lead " + "".join(edited) + " tail", item[: len(item) // 2], item.upper()]).withColumn("item_id", F.lit(5))
    some = bench.where("item_id = 0")
    assert sorted(r["doc_id"] for r in decontaminate.hits(df, some).collect()) == [2, 4]
    clean = decontaminate.decontaminate(df, some)
    assert clean.columns == df.columns and sorted(r["doc_id"] for r in clean.collect()) == [0, 1, 3]
    assert decontaminate.hits(df, bench.limit(0)).count() == 0


def test_decontamination_with_edits_equals_brute_force(spark):
    import random

    random.seed(8)
    some = ["".join(random.choices("abcdefgh ", k=random.randint(31, 120))) for _ in range(14)] + ["short item", "ab 12", "漢字 かな", "...", "a b"]
    items = {i: decontaminate.normal(t) for i, t in enumerate(some)}
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(random.randint(0, 3)):
            t = list(random.choice(some))
            for _ in range(random.choice([0, 0, 1, 2, 4, 8, 12])):
                i = random.randrange(len(t) + 1)
                t[i : i + random.randint(0, 1)] = random.choice(["", "x", "qq"])
            parts.append("".join(t))
        texts.append(random.choice(["w ", "w"]).join(["lead ", *parts, " tail"]))
    bench = spark.createDataFrame([*enumerate(some), (3, some[3]), (None, some[0])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.hits(frame(spark, texts), bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        n = decontaminate.normal(t)
        for i, x in items.items():
            k = decontaminate.budget(len(x) - 2)
            if x and (e := least_distance(x, n)) <= k:
                want[d, i] = e
                if i == 0:
                    want[d, None] = e
    assert got == {**want, **{(d, None): e for (d, i), e in want.items() if i == 0}} and any(want.values())
    assert {len(b) for b in decontaminate.item_blocks(bench, 300)} - {19}
    by_block = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.hits(frame(spark, texts), bench, size=300).collect()}
    assert by_block == got
    split = sorted(x for b in decontaminate.item_blocks(bench, 300) for x in map(repr, b))
    assert split == sorted(map(repr, next(decontaminate.item_blocks(bench))))


def test_decontamination_has_no_step_at_any_length(spark):
    """One letter changed: found as soon as the rate allows an edit, whatever the length; no item stands inside a word."""
    words = "abcde fghij klmno pqrst uvwxy zabcd efghi jklmn".split()
    for size in (12, 13, 28, 29, 30, 31):
        item = " ".join(words)[:size].strip()
        bench = spark.createDataFrame([(1, item)], "item_id long, text string")
        changed = item[:7] + "#".replace("#", "q") + item[8:]
        got = {r["doc_id"]: r["distance"] for r in decontaminate.hits(frame(spark, [f"lead {changed} tail", f"lead {item} tail", f"lead x{item}x tail"]), bench).collect()}
        k = decontaminate.budget(len(item))
        assert got == {1: 0} | ({0: 1} if k >= 1 else {}) | ({2: 2} if k >= 2 else {}), size


def test_decontamination_deals_one_item_id_over_blocks(spark):
    texts = [f"{'word' * 3} {i:05d} and some more of it" for i in range(60)]
    bench = spark.createDataFrame([(7, t) for t in texts] + [(None, t) for t in texts], "item_id long, text string")
    blocks = list(decontaminate.item_blocks(bench, 400))
    assert len(blocks) > 4 and max(map(len, blocks)) < 60
    docs = frame(spark, [f"x {texts[3]} y {texts[40]}", f"x {texts[3]} y {texts[40]}", "nothing"])
    docs = docs.unionByName(docs.where("doc_id = 0"))
    got = sorted((r["doc_id"], r["item_id"] or -1, r["distance"]) for r in decontaminate.hits(docs, bench, size=400).collect())
    assert got == [(0, -1, 0), (0, -1, 0), (0, 7, 0), (0, 7, 0), (1, -1, 0), (1, 7, 0)]


def least_distance(p, t):
    before = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        now = [i + 1]
        for j, d in enumerate(t):
            now.append(min(before[j] + (c != d), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_myers_equals_dynamic_programming():
    import random

    random.seed(2)
    for _ in range(800):
        p, t, k = "".join(random.choices("abc ", k=random.randint(1, 90))), "".join(random.choices("abc ", k=random.randint(0, 120))), random.randint(0, 9)
        assert decontaminate.Pattern(p).least(t, k) == min(least_distance(p, t), k + 1)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(str([r[c] for c in columns]) for r in df.collect())
    rel = con.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == columns
    assert got == sorted(str([dict(zip(rel.columns, r, strict=True))[c] for c in columns]) for r in rel.fetchall())


def test_line_dedup_edges(spark):
    rows = [(i, "common line\nown " + str(i), "en", f"s{i % 12}", 0) for i in range(24)] + [(50, None, "en", None, None), (51, "", "en", "s0", 0), (52, "common line", "en", "s1", 11)]
    df = spark.createDataFrame(rows, DOCS).withColumn("at", F.lit(1)).withColumn("digest", F.lit("x"))
    got = {r["doc_id"]: (r["n_removed"], r["clean_text"]) for r in line_dedup.clean(df).collect()}
    assert got[0] == (0, "common line\nown 0") and got[1] == (1, "own 1") and got[50] == (0, None) and got[51] == (0, "") and got[52] == (1, "")
    twice = spark.createDataFrame([*rows, (20, "UNIQUE ONE\ny", "en", "s0", 12), (None, "common line\nz", "en", "s0", 13), (None, "common line\nz", "en", "s0", 13)], DOCS)
    got = sorted((repr(r["doc_id"]), r["clean_text"] or "") for r in line_dedup.clean(twice).collect())
    assert ("20", "UNIQUE ONE\ny") in got and ("20", "own 20") in got and got.count(("None", "common line\nz")) == 2 and ("0", "own 0") in got
    left = line_dedup.without_boilerplate(df)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [*range(24), 50, 51]
    assert line_dedup.clean(df.limit(0)).count() == 0


def test_line_dedup_of_a_long_list(spark, docs, monkeypatch):
    want = sorted(map(repr, line_dedup.clean(docs).select("doc_id", "n_removed", F.md5("clean_text")).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    assert want == sorted(map(repr, line_dedup.clean(docs).select("doc_id", "n_removed", F.md5("clean_text")).collect()))


def test_line_dedup_replaces_columns_of_its_names(spark):
    df = frame(spark, ["a", "b"]).withColumns({"clean_text": F.lit(1), "n_removed": F.lit("x"), "a.b": F.lit(2)})
    out = line_dedup.clean(df)
    assert sorted(out.columns) == sorted([*df.columns, "n_lines"]) and [r["clean_text"] for r in out.orderBy("doc_id").collect()] == ["a", "b"]


def test_license_scan_canonical_forms(spark):
    mit = dict((i, t) for i, t in licenses.KNOWN if i == "MIT")["MIT"]
    shouted = "Copyright (c) 2020 Some Body\n\n" + mit.replace("sublicense", "sub­license").replace("sub­license", "sublicence").upper().replace(". ", ".\n\n   ")
    df = frame(spark, [None, "", mit, shouted, mit + " and more", "text\n  LICENSED under the Apache Licence, Version 2.0\nmore"])
    got = {r["doc_id"]: (r["license_id"], r["n_license_lines"], r["line_licenses"]) for r in licenses.scan(df, licenses.known(spark)).collect()}
    assert got[0] == got[1] == (None, 0, "")
    assert got[2][0] == got[3][0] == "MIT" and got[4][0] is None
    assert got[5] == (None, 1, "Apache-2.0-notice")
    assert licenses.scan(df.limit(0), licenses.known(spark)).count() == 0


def test_license_lines_with_a_copyright_and_folders(spark, tmp_path):
    (tmp_path / "House-1.0.txt").write_text("Copyright 1999 A. B. Writer\nDo as you PLEASE, per cent by percent.\nAll rights reserved")
    table = licenses.known(spark, str(tmp_path))
    texts = ["Copyright (c) 2020 J. Smith. Released under the MIT License.\nx", "do as you please\npercent by per cent. \n(c) 2001 C. Other. Licensed under CC BY 4.0.", "word " * 200000]
    got = {r["doc_id"]: (r["license_id"], r["line_licenses"]) for r in licenses.scan(frame(spark, texts), table).collect()}
    assert got == {0: (None, "MIT-notice"), 1: ("House-1.0", "CC-BY-4.0-notice"), 2: (None, "")}
    repeated = spark.createDataFrame([(1, licenses.KNOWN[0][1]), (1, "other")], "doc_id long, text string")
    row = licenses.scan(repeated, table).first()
    assert (row["license_id"] == "MIT") == (row["digest"] in {r["digest"] for r in table.where("license_id = 'MIT'").collect()})


def test_known_digests_are_those_of_published_files(spark):
    import pathlib

    folder = pathlib.Path("/usr/share/common-licenses")
    files = [folder / n for n in ("Apache-2.0", "GPL-3", "MPL-2.0") if (folder / n).exists()]
    if not files:
        pytest.skip("no licence texts on this machine")
    got = licenses.scan(frame(spark, [f.read_text() for f in files]), licenses.known(spark)).orderBy("doc_id").collect()
    assert [r["license_id"] for r in got] == [{"GPL-3": "GPL-3.0"}.get(f.name, f.name) for f in files]


def test_chat_round_trip(spark):
    hard = ["<|im_end|>", "<\\|im_start|>", "<\\\\|", "<", "|", "ends <", "", None, "a\nb", "é🙂"]
    rows = [(c, t, "assistant" if t % 2 else "us\\er\n", hard[(c + t) % len(hard)]) for c in range(12) for t in range(7)]
    df = spark.createDataFrame([*rows, (None, None, None, None)], "conv_id long, turn long, role string, text string")
    chunks = chat_format.format_conversations(df).collect()
    for r in chunks:
        turns = list(chat_format.parse(bytes(r["formatted"]).decode()))
        assert turns == ([(x[2], x[3] or "") for x in sorted(rows) if x[0] == r["conv_id"]] if r["conv_id"] is not None else [("", "")])
        said = [chat_format.unescape(bytes(r["formatted"])[a:b].decode()) for a, b in zip(r["loss"][::2], r["loss"][1::2], strict=True)]
        assert said == [t for role, t in turns if role == "assistant"]
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_control_strings_in_roles_and_long_texts(spark):
    long = "<|im_end|>" * 1000 + "é" * 7000
    rows = [(1, t, "x<|im_end|>\\\n<\\|" if t % 3 else "assistant", long if t % 2 else f"t{t}") for t in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chunks = chat_format.format_conversations(df, block=5000).orderBy("chunk").collect()
    assert len(chunks) > 10
    turns = [x for r in chunks for x in chat_format.parse(bytes(r["formatted"]).decode())]
    assert turns == [(r[2], r[3]) for r in rows] and all(bytes(r["formatted"]).count(b"<|im_end|>") == bytes(r["formatted"]).count(b"<|im_start|>") for r in chunks)


def test_chat_conversation_over_several_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    df = spark.createDataFrame([(1, t, "assistant", f"t{t}") for t in range(55)] + [(2, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.digests(store.materialise(chat_format.format_conversations(df), "chat")).collect()}
    assert got[1]["n_turns"] == 55 and got[1]["loss_sha256"] == hashlib.sha256("".join(f"t{t}" for t in range(55)).encode()).hexdigest()
    assert got[2]["loss_chars"] == 0


def test_pipeline_stages_against_brute_force(spark, docs, texts, sf_dir):
    import corpus_pipeline as cp

    at = docs
    for name, stage in cp.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in at.collect()}
        out = store.materialise(stage(spark, at, sf_dir), name)
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.columns == docs.columns and set(after) <= set(before)
        if name == "language_id":
            assert {d for d in before if d not in after} <= {d for d, t in before.items() if not re.search(r"[^\W\d_]", t or "") or len(WORD.findall(t)) < 3}
        if name == "near_dedup":
            assert set(after) == {c for _, c in brute_components(before).values()}
        if name == "decontaminate":
            items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert not any(x in decontaminate.normal(t) for t in after.values() for x in items)
        at = out
    placed = cp.STAGES[-1][1](spark, at, sf_dir)
    assert {r["doc_id"] for r in placed.select("doc_id").distinct().collect()} == set(after)


def test_pipeline_stages_on_odd_rows(spark, docs, tmp_path):
    import random

    import corpus_pipeline as cp

    some = {r["lang"]: r["text"] for r in docs.where("length(text) between 300 and 2000").groupBy("lang").agg(F.max("text").alias("text")).collect()}
    some = {k: " ".join(random.Random(k).choices(t.split(), k=150)) for k, t in some.items()}  # like nothing else
    late = " ".join(random.Random("late").choices(some["es"].split(), k=150))
    item = "".join(chr(97 + i * 7 % 26) + (" " if i % 5 == 4 else "") for i in range(120))
    rows = [(None, some["en"]), (None, some["en"]), (7, some["fr"]), (7, some["de"]), (8, None), (9, ""), (10, "12 34"), (11, some["es"] + " " + item), (12, (late + "\n") * 400)]
    extra = {c: F.lit("x") for c in ("text_hash", "row", "root", "digest", "number", "length", "h", "i", "label", "class_id", "_drop", "shingles", "a.b", "doc_id.x", "_has_letter_", "has_letter", "clean_text", "n_removed", "n_lines", "_row", "c0", "c1", "_kept_id")}
    df = spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], DOCS).unionByName(docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id between 100 and 140")).withColumns(extra)
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = df
    for name, stage in cp.STAGES[:-1]:
        at = store.materialise(stage(spark, at, str(tmp_path)), name)
        assert at.columns == df.columns
    left = [(r["doc_id"], (r["text"] or "")[:5]) for r in at.where("doc_id is null or doc_id < 100").collect()]
    assert sorted(map(repr, left)) == sorted(map(repr, [(None, some["en"][:5]), (7, some["fr"][:5]), (7, some["de"][:5]), (12, late[:5])]))
    placed = cp.STAGES[-1][1](spark, at, str(tmp_path))
    assert placed.agg(F.sum("length")).first()[0] == sum(len(plain_ids(r["text"])) for r in at.collect())
    for name, stage in cp.STAGES:
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
