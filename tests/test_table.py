"""Versioned tables: races, crashes at each step, growth and upkeep."""

import pytest

from claimlake.operators import table as tables
from pyspark.sql import functions as F

from claimlake.operators.table import Conflict, VersionedTable
from claimlake.plans.incremental import GoldViews

SCHEMA = "id int, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(table, version=None):
    return sorted((r["id"], r["v"]) for r in table.read(version).collect())


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.upsert(frame(spark, [(i, "a") for i in range(20)]), ["id"], buckets=8)
    return t


def test_versions_and_few_buckets(spark, table):
    before = table.snapshot()
    after = table.upsert(frame(spark, [(3, "b"), (50, "n")]), ["id"], gone=frame(spark, [(4, "")]), buckets=64)
    assert after.version == 1 and after.buckets == 8
    assert state(table) == sorted([(i, "b" if i == 3 else "a") for i in range(20) if i != 4] + [(50, "n")])
    assert state(table, 0) == [(i, "a") for i in range(20)]
    assert sum(before.parts.get(k) != v for k, v in after.parts.items()) <= 3
    assert sorted({r["id"] for r in table.read_of(frame(spark, [(3, "")])).collect()}) != sorted(r[0] for r in state(table))


def race(table, monkeypatch, other):
    """``other`` commits after the table has written its files and before its manifest."""
    real, done = VersionedTable._put_if_absent, []

    def late(self, where, text):
        if not done:
            done.append(1)
            other()
        return real(self, where, text)

    monkeypatch.setattr(VersionedTable, "_put_if_absent", late)


def test_racing_writers_of_one_key(spark, table, monkeypatch):
    race(table, monkeypatch, lambda: VersionedTable(spark, table.path).upsert(frame(spark, [(1, "other"), (60, "x")]), ["id"]))
    table.upsert(frame(spark, [(1, "mine"), (61, "y")]), ["id"])
    assert table.versions() == [0, 1, 2]
    assert state(table) == sorted([(i, "mine" if i == 1 else "a") for i in range(20)] + [(60, "x"), (61, "y")])


def test_racing_writers_of_other_buckets_keep_their_files(spark, table, monkeypatch):
    number = {r["id"]: r["b"] for r in frame(spark, [(i, "") for i in range(20)]).selectExpr("id", "cast(pmod(xxhash64(id), 8) as int) as b").collect()}
    mine = 0
    theirs = next(i for i in range(20) if number[i] != number[mine])
    written = []
    real = VersionedTable._counts
    monkeypatch.setattr(VersionedTable, "_counts", lambda self, folder, *a: (written.append(folder), real(self, folder, *a))[1])
    race(table, monkeypatch, lambda: VersionedTable(spark, table.path).upsert(frame(spark, [(theirs, "other")]), ["id"]))
    table.upsert(frame(spark, [(mine, "mine")]), ["id"])
    assert len(written) == 2  # one each: nothing was written twice
    assert dict(state(table)) == {i: "a" for i in range(20)} | {mine: "mine", theirs: "other"}


def test_a_commit_that_depends_on_a_version_fails(spark, table):
    seen = table.snapshot().version
    table.upsert(frame(spark, [(1, "b")]), ["id"])
    with pytest.raises(Conflict):
        table.upsert(frame(spark, [(1, "c")]), ["id"], expected=seen)
    assert dict(state(table))[1] == "b"


@pytest.mark.parametrize("step", ["_counts", "_put_if_absent"])
def test_a_crash_leaves_the_version_before(spark, table, monkeypatch, step):
    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, step, dies)
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, [(1, "b")]), ["id"])
    assert table.versions() == [0] and dict(state(table))[1] == "a"
    assert table.vacuum(older_than=3600) == 0 and table.vacuum(older_than=0) == 1
    table.upsert(frame(spark, [(1, "c")]), ["id"])
    assert dict(state(table))[1] == "c"


def test_a_draft_of_a_crash_is_no_version(spark, table):
    table._write_text(f"{table.path}/log/.draft", "{")
    assert table.versions() == [0] and len(state(table)) == 20
    assert table.vacuum(older_than=0) == 1


def test_buckets_grow_with_the_table(spark, table, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 2)
    after = table.upsert(frame(spark, [(1, "b"), (70, "n")]), ["id"], gone=frame(spark, [(2, "")]))
    assert after.buckets > 8 and after.rows == 20
    assert state(table) == sorted([(i, "b" if i == 1 else "a") for i in range(20) if i != 2] + [(70, "n")])


def test_tags_commit_once(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "log"))
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id int, kind string")
    for tag in (("s", 0), ("s", 0), ("s", 1), ("other", 0), ("s", 1)):
        t.append(rows, "kind", tag)
    assert t.read().count() == 6 and t.versions() == [0, 1, 2]
    assert sorted({(r["id"], r["kind"]) for r in t.read().collect()}) == [(1, "x"), (2, "y")]


def test_expire_keeps_what_versions_need(spark, table):
    for i in range(4):
        table.upsert(frame(spark, [(i, f"v{i}")]), ["id"])
    want = state(table)
    assert table.expire(keep=2) == [0, 1, 2]
    assert state(table) == want and len(state(table, 3)) == 20
    assert table.vacuum(older_than=0) == 0
    with pytest.raises(Exception, match="0000"):
        table.snapshot(1)


def test_all_rows_gone_and_new_columns(spark, table):
    table.upsert(spark.createDataFrame([(1, "b", 7)], SCHEMA + ", extra int"), ["id"])
    assert {r["id"]: r["extra"] for r in table.read().collect()} == {i: 7 if i == 1 else None for i in range(20)}
    table.upsert(table.read().limit(0), ["id"], gone=table.read().select("id"))
    assert table.read().count() == 0 and table.snapshot().rows == 0


def test_gold_views_touch_their_groups_only(spark, tmp_path):
    payers = spark.createDataFrame([(i, f"p{i}", "commercial") for i in range(8)], "payer_id long, name string, type string")
    views = GoldViews(spark, str(tmp_path / "views"), payers, buckets=8)
    event = "_cdc_operation string, _cdc_timestamp timestamp, _cdc_seq long, _source_table string, payload string"
    import datetime

    at = datetime.datetime(2024, 1, 1)
    claim = lambda op, seq, i, payer, billed: (op, at, seq, "claims", '{"claim_id":%d,"payer_id":%d,"date_of_service":"2024-01-%02d","status":"filed","total_billed":%s}' % (i, payer, i + 1, billed))
    paid = lambda op, seq, i, remit, amount: (op, at, seq, "remittances", '{"claim_id":%d,"remit_id":%d,"paid_amount":%s,"allowed_amount":1}' % (i, remit, amount))
    views.apply(spark.createDataFrame([claim("I", 0, i, i, 100) for i in range(8)] + [paid("I", 0, 1, 1, 10)], event), ("t", 0))
    before = views.by_payer.snapshot()
    batch = spark.createDataFrame([claim("U", 1, 2, 3, 50), paid("U", 1, 1, 1, 30), paid("I", 1, 1, 2, 5), paid("D", 2, 1, 2, 0), claim("D", 1, 4, 4, 0)], event)
    views.apply(batch, ("t", 1))
    views.apply(batch, ("t", 1))  # once more
    got = {r["payer_id"]: (r["total_claims"], r["total_billed"], r["total_paid"]) for r in views.recovery().collect()}
    assert got == {0: (1, 100.0, 0.0), 1: (1, 100.0, 30.0), 3: (2, 150.0, 0.0), 5: (1, 100.0, 0.0), 6: (1, 100.0, 0.0), 7: (1, 100.0, 0.0)}
    number = {r["payer_id"]: str(r["b"]) for r in payers.selectExpr("payer_id", "cast(pmod(xxhash64(payer_id), 8) as int) as b").collect()}
    after = views.by_payer.snapshot()
    touched = {number[i] for i in (1, 2, 3, 4)}
    assert all(before.parts.get(b) == after.parts.get(b) for b in number.values() if b not in touched)


def test_gold_views_read_a_batch_once_for_each_table(spark, tmp_path):
    """Events of claims and of remittances are parsed once each, however many tables they change."""
    payers = spark.createDataFrame([(0, "p", "commercial")], "payer_id long, name string, type string")
    views = GoldViews(spark, str(tmp_path / "views"), payers, buckets=2)
    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    claim = '{"claim_id":%d,"payer_id":0,"date_of_service":"2024-01-01","total_billed":10}'
    paid = '{"claim_id":%d,"remit_id":1,"paid_amount":%d}'
    for turn in range(2):
        rows = [("I", turn, "claims", claim % i) for i in range(6)] + [("I", turn, "remittances", paid % (i, turn + 1)) for i in range(6)]
        events = spark.createDataFrame(rows, "_cdc_operation string, _cdc_seq long, _source_table string, payload string")
        events = events.selectExpr("_cdc_operation", "timestamp'2024-01-01 00:00:00' as _cdc_timestamp", "_cdc_seq", "_source_table", "payload")
        views.apply(events.withColumn("payload", F.udf(counted).asNondeterministic()("payload")), ("t", turn))
    assert seen.value <= 2 * 2 * 12
    assert [(r["total_claims"], r["total_paid"]) for r in views.recovery().collect()] == [(6, 12.0)]
    assert views.remits.read().count() == 6


def test_rows_of_a_key_are_told_apart_within(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "w"))
    put = lambda rows, gone=None: t.upsert(spark.createDataFrame(rows, "id int, n int, v string"), ["id"], gone=spark.createDataFrame(gone, "id int, n int") if gone else None, buckets=2, within=["n"])
    put([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 2, "d")])
    put([(1, 2, "B"), (1, 3, "e")], [(2, 1)])
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 1, "a"), (1, 2, "B"), (1, 3, "e"), (2, 2, "d")]


def test_ranged_diff_reads_changed_ranges_only(spark, tmp_path):
    from claimlake.operators import merge
    from claimlake.operators.digests import SnapshotState

    state = SnapshotState(spark, str(tmp_path / "state"), buckets=64)
    one = [(i, f"v{i}") for i in range(300)]
    events = lambda df: sorted((r["_cdc_operation"], r["row_pk"], r["payload"]) for r in df.select("_cdc_operation", "row_pk", "payload").collect())
    first = state.diff(frame(spark, one), ["id"], "t")
    _, old = merge.snapshot_diff(frame(spark, one), ["id"], None, "t")
    assert len(events(first)) == 300 and {e[0] for e in events(first)} == {"I"}
    two = [(i, "new" if i == 7 else v) for i, v in one if i != 9] + [(900, "n"), (901, None)]
    want = events(merge.snapshot_diff(frame(spark, two), ["id"], old, "t")[0])
    before = state.rows.snapshot().parts
    assert events(state.diff(frame(spark, two), ["id"], "t")) == want and len(want) == 4
    assert 1 <= len(state.read_leaves) <= 4
    after = state.rows.snapshot().parts
    assert {int(k) for k in before.keys() | after.keys() if before.get(k) != after.get(k)} <= set(state.read_leaves)
    assert events(state.diff(frame(spark, two), ["id"], "t")) == [] and state.read_leaves == []
    gone = state.diff(frame(spark, two).limit(0), ["id"], "t")
    assert {e[0] for e in events(gone)} == {"D"} and gone.count() == 301
