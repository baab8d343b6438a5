"""Selection, sketches and the index of trigrams against plain computation."""

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimlake.operators import ingest
from claimlake.operators.selection import exact_median
from claimlake.operators.text_index import ChunkIndex
from claimlake.plans import quality
from claimlake.sources import files


def test_medians_equal_sorted_ones(spark):
    r = random.Random(3)
    rows = [("a", i % 3 or None, Decimal(r.choice([-5, 0, 7, r.randrange(-(10**14), 10**14)])) / 100) for i in range(300)]
    rows += [("one", 1, Decimal("1.01")), ("two", 1, Decimal("1.01")), ("two", 1, Decimal("-3.00")), ("same", 1, Decimal("2.50")), ("same", 1, Decimal("2.50")), ("none", 1, None), ("a", None, None)]
    df = spark.createDataFrame(rows, "k string, m int, v decimal(18,2)").repartition(5)
    got = {(x["k"], x["m"]): (x["n"], x["median"]) for x in exact_median(df, ["k", "m"], "v").collect()}
    groups: dict = {}
    for k, m, v in rows:
        groups.setdefault((k, m), []).extend([v] if v is not None else [])
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert got[g][0] == len(values)
        assert got[g][1] == pytest.approx(float(statistics.median(values))) if values else got[g][1] is None
    assert exact_median(df.limit(0), ["k"], "v").count() == 0
    with pytest.raises(TypeError):
        exact_median(df, ["k"], "m")


def test_quantiles_within_their_bound_and_merged(spark):
    r = random.Random(4)
    rows = [(d, r.gauss(10 * d, 5), r.randrange(4)) for d in range(3) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "d int, x double, y int").repartition(4)
    sketches = quality.day_sketches(df, ["x", "y"], F.col("d"))
    by_day = {(s["column_name"], s["day"]): s for s in quality.merged_quantiles(sketches, "day").collect()}
    for d in range(3):
        values = sorted(x for k, x, _ in rows if k == d)
        for q in quality.QUANTILES:
            at = by_day["x", d][f"q{round(q * 100):02d}"]
            assert abs(sum(v <= at for v in values) / len(values) - q) < 0.0165
    every = {s["column_name"]: s for s in quality.merged_quantiles(sketches).collect()}
    values = sorted(x for _, x, _ in rows)
    assert every["x"]["n"] == 60_000 and all(abs(sum(v <= every["x"][f"q{round(q * 100):02d}"] for v in values) / 60_000 - q) < 0.0165 for q in quality.QUANTILES)
    drift = {(s["column_name"], s["day"]): (s["gap"], s["drifts"]) for s in quality.distribution_drift(sketches).collect()}
    assert drift["x", 0] == (None, False) and drift["x", 1][1] and not drift["y", 2][1]


def test_frequent_values_are_exact(spark):
    r = random.Random(5)
    rows = [(d, r.choice(["a"] * 30 + ["b"] * 6 + [None] * 8 + [f"v{i}" for i in range(60)])) for d in range(2) for _ in range(3000)]
    df = spark.createDataFrame(rows, "d int, v string").repartition(4)
    got = {(x["day"], x["value"]): x["value_count"] for x in quality.frequent_values(df, ["v"], F.col("d")).collect()}
    count: dict = {}
    for d, v in rows:
        count[d, v] = count.get((d, v), 0) + 1
    assert got == {k: c for k, c in count.items() if c >= 0.05 * 3000}


def test_trigram_search_equals_a_scan(spark, tmp_path):
    r = random.Random(6)
    words = ["arbitration", "Claim", "idr", "né à", "denial", "x", "𝒳yz"]
    chunks = [(i, " ".join(r.choices(words, k=r.randrange(0, 6))), r.choice(["CA", "NY"]), None) for i in range(200)] + [(500, None, "CA", None), (501, "", "CA", None)]
    schema = "chunk_id long, chunk_text string, jurisdiction string, superseded_date date"
    df = spark.createDataFrame(chunks, schema).withColumn("effective_date", F.lit("2020-01-01").cast("date"))
    index = ChunkIndex(spark, str(tmp_path / "index"), buckets=4)
    index.add(df.where("chunk_id < 100"))
    index.add(df.where("chunk_id >= 90"))  # ten come again
    for ask in (["arbitration"], ["IDR", "denial"], ["né à"], ["claim idr"], ["x"], ["zz", "denial"], ["nothing"], ["𝒳y"], ["𝒳yz"]):
        show = lambda rows: [(x["chunk_id"], x["matches"]) for x in rows.collect()]
        assert show(index.search(ask, "CA", "2024-01-01", 1000)) == show(ingest.search_chunks(df, ask, "CA", "2024-01-01", 1000)), ask
    some = index.candidates(["nothing at all"])
    assert some.count() == 0
    index.add(spark.createDataFrame([(3, "changed text", "CA", None)], schema).withColumn("effective_date", F.lit("2020-01-01").cast("date")))
    assert [x["chunk_id"] for x in index.search(["changed"]).collect()] == [3]
    now = index.chunks.read()
    assert now.count() == 202 and all(show(index.search([w], k=1000)) == show(ingest.search_chunks(now, [w], k=1000)) for w in ("arbitration", "claim"))


def test_jdbc_loads_in_parts_after_the_stored_watermark(spark, tmp_path):
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    try:
        spark._jvm.java.lang.Class.forName(driver["driver"])
    except Exception:
        pytest.skip("no database in this installation")
    from claimlake.operators.table import VersionedTable

    url, path = "jdbc:derby:memory:parts;create=true", str(tmp_path / "t")
    spark.range(1, 101).selectExpr("id", "timestamp_seconds(1700000000 + id * 3600) as changed").coalesce(1).write.jdbc(url, "t", properties=driver)
    rows = files.jdbc_table(spark, url, "t", "id", 20, 4, **driver)
    assert rows.rdd.getNumPartitions() == 4 and sorted(r[0] for r in rows.collect()) == list(range(21, 101))
    by_time = files.jdbc_table(spark, url, "t", "changed", None, 3, **driver)
    assert by_time.rdd.getNumPartitions() == 3 and by_time.count() == 100
    assert files.jdbc_load(spark, url, "t", "id", path, **driver) == 0
    real = VersionedTable._put_if_absent
    spark.range(101, 111).selectExpr("id", "timestamp_seconds(1700000000 + id * 3600) as changed").coalesce(1).write.mode("append").jdbc(url, "t", properties=driver)
    VersionedTable._put_if_absent = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            files.jdbc_load(spark, url, "t", "id", path, **driver)
    finally:
        VersionedTable._put_if_absent = real
    files.jdbc_load(spark, url, "t", "id", path, **driver)  # the rows that were lost come now, once
    files.jdbc_load(spark, url, "t", "id", path, **driver)
    got = VersionedTable(spark, path).read()
    assert sorted(r[0] for r in got.select("id" if "id" in got.columns else "ID").collect()) == list(range(1, 111))


def test_trigrams_go_by_characters(spark):
    """Also of characters beyond 16 bits, of which no half is a character; a short or missing text has none."""
    from claimlake.operators.text_index import trigrams

    texts = ["ABcabC", "a\U0001f600b\nc", "ab", "", None, "\u00c4\u00d6\u00fc\u00e4"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r["id"]: r["g"] and sorted(r["g"]) for r in rows.select("id", trigrams(F.col("t")).alias("g")).collect()}
    assert got == {0: ["abc", "bca", "cab"], 1: sorted(["a\U0001f600b", "\U0001f600b\n", "b\nc"]), 2: [], 3: [], 4: None, 5: ["\u00e4\u00f6\u00fc", "\u00f6\u00fc\u00e4"]}
