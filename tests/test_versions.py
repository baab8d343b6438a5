"""Claims as a stream's state: any order and any cut into batches gives what E1 and E2 give in one batch."""

import datetime
import itertools

import pytest

from claimlake import streaming
from claimlake.operators import ingest
from claimlake.streaming import versions

SCHEMA = "claim_id string, frequency_code string, arrival timestamp, status string, total_billed double, at timestamp, lines array<struct<cpt_code:string>>"
VALUES = "total_billed double, at timestamp, lines array<struct<cpt_code:string>>"


def day(n):
    return datetime.datetime(2024, 1, n)


def record(claim, code, n, total, *lines, status=None):
    at = datetime.datetime(2024, 3, 1, 1, 2, 3, 456789)
    return (claim, code, day(n) if n else None, status, total, at, [(x,) for x in lines])


def run(spark, tmp_path, batches, name="r"):
    src, out, cp = (str(tmp_path / f"{name}-{x}") for x in ("in", "out", "cp"))
    for batch in batches:  # each is a run of its own, which goes on from the checkpoint
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        streaming.run_to_table(versions.claim_changes(streaming.source(spark, src, SCHEMA)), out, cp)
    return spark.read.parquet(out)


def state_of(log):
    rows = versions.current(log, VALUES).collect()
    return sorted((r["claim_id"], r["total_billed"], r["status"], tuple(x["cpt_code"] for x in r["lines"])) for r in rows)


STORED = [record("k", None, None, 5.0, "a", "b", status="filed"), record("u", None, None, 1.0, "z", status="filed")]
RECORDS = [
    record("k", "7", 3, 6.0, "c"),
    record("k", "8", 4, 5.0),
    record("k", "7", 5, 8.0, "d", "e"),
    record("n", "1", 1, 7.0, "f"),
    record("n", "7", 2, 9.0, "g"),
    record("n", "1", 3, 7.5, "h"),
    record("v", "1", 1, 2.0, "i"),
    record("v", "8", 6, 2.0),
    record("e", "8", 2, 3.0, "j"),
    record("t", "7", 2, 4.0, "k"),
    record("t", "8", 2, 4.0, "l"),
    record("t", "1", 2, 4.0, "m"),
    record(None, "1", 1, 0.0, "x"),
]


@pytest.fixture(scope="module")
def want(spark):
    """By E1 and E2 in one batch."""
    claims = spark.createDataFrame([(r[0], r[4], r[3]) for r in STORED], "claim_id string, total_billed double, status string")
    lines = spark.createDataFrame([(r[0], i + 1, x[0]) for r in STORED for i, x in enumerate(r[6])], "claim_id string, line_number int, cpt_code string")
    incoming = spark.createDataFrame([r for r in RECORDS if r[0]], SCHEMA).drop("status", "at")
    got, got_lines = ingest.apply_claim_actions(claims, lines, ingest.claim_actions(incoming, claims))
    of = {k: tuple(r["cpt_code"] for r in g) for k, g in itertools.groupby(sorted(got_lines.collect(), key=lambda r: (r["claim_id"], r["line_number"])), key=lambda r: r["claim_id"])}
    return sorted((r["claim_id"], r["total_billed"], r["status"], of.get(r["claim_id"], ())) for r in got.collect())


@pytest.mark.parametrize("name, batches", [
    ("one", [STORED + RECORDS]),
    ("backwards", [STORED, RECORDS[7:][::-1], RECORDS[:7][::-1]]),
    ("turned", [STORED, RECORDS[1::3], RECORDS[2::3], RECORDS[::3]]),
])
def test_order_and_batches_do_not_matter(spark, tmp_path, want, name, batches):
    assert state_of(run(spark, tmp_path, batches, name)) == want


def test_late_original_and_repeats(spark, tmp_path):
    log = run(spark, tmp_path, [[record("n", "7", 2, 9.0, "g")], [record("n", "1", 1, 7.0, "f")], [record("n", "1", 1, 7.0, "f"), record("n", "1", 3, 1.0, "q")]])
    changes = sorted((r["version"], r["status"], r["payload"] is None) for r in log.collect())
    assert changes == [(1, "received", False), (2, "corrected", True)]  # a repeat makes no change
    got = versions.current(log, VALUES).first()
    assert got["total_billed"] == 9.0 and got["at"] == datetime.datetime(2024, 3, 1, 1, 2, 3, 456789)


def test_record_sent_twice_counts_once(spark, tmp_path):
    """A void or replacement that opens a claim and is sent again doesn't void or correct what it opened."""
    twice = [record("e", "8", 2, 3.0, "j"), record("f", "7", 2, 3.0, "k")]
    log = run(spark, tmp_path, [twice + twice, twice])
    assert log.count() == 2 and state_of(log) == [("e", 3.0, "received", ("j",)), ("f", 3.0, "received", ("k",))]


def test_state_ends(spark, tmp_path):
    """A claim of which nothing comes for so long is new again, and records behind the watermark are dropped."""
    old, new = record("n", "1", 1, 7.0, "f"), list(record("m", "1", 1, 1.0, "g"))
    new[2] = datetime.datetime(2026, 1, 1)
    again = list(record("n", "7", 1, 8.0, "h"))
    again[2] = datetime.datetime(2026, 1, 2)
    log = run(spark, tmp_path, [[old], [tuple(new)], [record("n", "7", 2, 9.0, "late")], [tuple(again)]])
    assert state_of(log) == [("m", 1.0, "received", ("g",)), ("n", 8.0, "received", ("h",))]


def test_many_claims_share_a_group(spark, tmp_path):
    """Of all claims in one group each has its own turns and end, also when the group is rewritten by others."""
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for batch in ([record(f"c{i}", "1", 1, float(i), "a") for i in range(500)], [record(f"c{i}", "7", 2, -float(i), "b") for i in range(0, 500, 5)]):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        streaming.run_to_table(versions.claim_changes(streaming.source(spark, src, SCHEMA), buckets=1), out, cp)
    assert state_of(spark.read.parquet(out)) == sorted((f"c{i}", float(i) if i % 5 else -float(i), "received" if i % 5 else "corrected", ("a",) if i % 5 else ("b",)) for i in range(500))
