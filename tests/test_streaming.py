import datetime

from claimlake import streaming
from claimlake.operators.table import VersionedTable


def ts(h, m=0):
    return datetime.datetime(2024, 1, 1, h, m)


def test_bronze_reads_each_file_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(src)
    schema = "id int, v string"
    streaming.bronze(spark, src, schema, "t", out, cp).awaitTermination()
    spark.createDataFrame([(2, "b")], schema).write.mode("append").parquet(src)
    streaming.bronze(spark, src, schema, "t", out, cp).awaitTermination()
    got = VersionedTable(spark, out).read()
    assert sorted(r["id"] for r in got.collect()) == [1, 2] and got.first()["_cdc_operation"] == "I"


def test_duplicates_and_windows(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.createDataFrame([("e1", "claim", ts(1)), ("e1", "claim", ts(1, 5)), ("e2", "error", ts(2))], "event_id string, kind string, at timestamp").coalesce(1).write.parquet(src)
    stream = streaming.source(spark, src, "event_id string, kind string, at timestamp")
    streaming.run_to_table(streaming.deduplicated(stream, ["event_id"], "at"), str(tmp_path / "d"), str(tmp_path / "c1"))
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "d")).collect()) == ["e1", "e2"]
    counts = streaming.rolling_counts(stream, "at", "kind")
    q = counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["kind"], r["n"]) for r in spark.table("counts").collect()) == [("claim", 2), ("error", 1)]


def test_idempotent_claims(spark, tmp_path):
    claims, lines, src = (str(tmp_path / x) for x in ("claims", "lines", "in"))
    stored_claims, stored_lines = VersionedTable(spark, claims), VersionedTable(spark, lines)
    old = spark.createDataFrame([("k", 5.0, "received")], "claim_id string, total_billed double, status string")
    stored_claims.upsert(old, ["claim_id"])
    stored_lines.upsert(spark.createDataFrame([("k", 1, "99213"), ("k", 2, "99214"), ("k", 3, "99215")], "claim_id string, line_number int, cpt_code string"), ["claim_id"])
    schema = "claim_id string, frequency_code string, arrival int, total_billed double, lines array<struct<cpt_code:string>>"
    spark.createDataFrame([("n", "1", 1, 7.0, [("1",)]), ("k", "7", 2, 6.0, [("2",)]), ("n", "1", 3, 9.0, [("9",)])], schema).coalesce(1).write.parquet(src)
    streaming.ingest_claims(streaming.source(spark, src, schema), claims, lines, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r["claim_id"], r["total_billed"], r["status"]) for r in stored_claims.read().collect()) == [("k", 6.0, "corrected"), ("n", 7.0, "received")]
    assert sorted((r["claim_id"], r["cpt_code"]) for r in stored_lines.read().collect()) == [("k", "2"), ("n", "1")]


def test_claims_batch_that_stops_between_its_commits(spark, tmp_path, monkeypatch):
    """The lines of a batch are in, its claims aren't; the batch is run again and leaves what one run leaves."""
    claims, lines, src, cp = (str(tmp_path / x) for x in ("claims", "lines", "in", "cp"))
    stored_claims, stored_lines = VersionedTable(spark, claims), VersionedTable(spark, lines)
    stored_claims.upsert(spark.createDataFrame([("k", 5.0, "received")], "claim_id string, total_billed double, status string"), ["claim_id"])
    stored_lines.upsert(spark.createDataFrame([("k", 1, "a")], "claim_id string, line_number int, cpt_code string"), ["claim_id"])
    schema = "claim_id string, frequency_code string, arrival int, total_billed double, lines array<struct<cpt_code:string>>"
    spark.createDataFrame([("k", "7", 1, 6.0, [("b",), ("c",)]), ("n", "1", 2, 7.0, [("d",)])], schema).coalesce(1).write.parquet(src)
    real, calls = VersionedTable.upsert, []

    def dies(self, *args, **named):
        calls.append(self.path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(self, *args, **named)

    monkeypatch.setattr(VersionedTable, "upsert", dies)
    run = lambda: streaming.ingest_claims(streaming.source(spark, src, schema), claims, lines, cp).awaitTermination()
    try:
        run()
        raise AssertionError("the batch should have failed")
    except Exception as error:
        assert "lost" in str(error)
    assert stored_lines.read().count() == 3 and stored_claims.read().count() == 1
    run()
    assert sorted((r["claim_id"], r["total_billed"], r["status"]) for r in stored_claims.read().collect()) == [("k", 6.0, "corrected"), ("n", 7.0, "received")]
    assert sorted((r["claim_id"], r["cpt_code"]) for r in stored_lines.read().collect()) == [("k", "b"), ("k", "c"), ("n", "d")]
    assert len(stored_lines.versions()) == 2


def test_topics_take_a_batch_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "topic string, n int").write.parquet(src)
    run = lambda: streaming.fan_out(streaming.source(spark, src, "topic string, n int"), out, cp).awaitTermination()
    run()
    for name in ("0", ".0.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    run()
    assert sorted((r["topic"], r["n"]) for r in VersionedTable(spark, out).read().collect()) == [("a", 1), ("a", 3), ("b", 2)]
