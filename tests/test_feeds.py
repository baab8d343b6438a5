"""Rendered feeds: many files in few folders, and segments without a copy of their file."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimlake.operators import sinks
from claimlake.sources import files, parsers

HEAD = "ISA*00*          *00*          *ZZ*SENDER         *ZZ*RECEIVER       *240101*1200*^*00501*000000001*0*P*:"


def test_files_lie_together_and_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1, 2, "b"), (0, 1, 1, "a"), (0, 1, 3, None), (0, 2, 1, "c"), (1, 7, 1, None)], "folder long, file_no long, k int, text string")
    assert sinks.text_files(rows, str(tmp_path / "out"), ["k", "text"], ",", "[", "]") == 3
    got = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in Path(tmp_path / "out").rglob("*") if p.is_file()}
    assert got == {"folder=0/1.txt": "[a,b]\n", "folder=0/2.txt": "[c]\n", "folder=1/7.txt": "[]\n"}
    assert sorted(r["content"] for r in files.whole_texts(spark, str(tmp_path / "out")).collect()) == ["[]\n", "[a,b]\n", "[c]\n"]
    assert sinks.text_files(rows.limit(0), str(tmp_path / "none"), ["k"]) == 0
    assert files.whole_texts(spark, str(tmp_path / "none")).count() == 0


def test_feeds_have_fewer_folders_than_files(spark, sf_dir):
    from claimlake.source_queries import _texts, _x12_claim_files
    from claimlake.sources.mapped import Mapped

    for make in (_texts, _x12_claim_files):
        path = Path(make(Mapped(spark, sf_dir)).removeprefix("file://"))
        found = list(path.rglob("*.txt"))
        assert len(found) > 1 and len({f.parent for f in found}) <= -(-len(found) // 100) + 1


def test_segments_carry_no_text(spark):
    df = spark.createDataFrame([("f", HEAD + "~ST*837*1~")], "file string, content string")
    plan = parsers.segments(df)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Generate":
        plan = plan.children().apply(0)
    assert "content" not in plan.output().toString()


def test_newlines_and_separators(spark):
    texts = [HEAD + "~\r\nST*837*1~ CLM*a\nb*1 ~\n~SV1* x~", HEAD.replace("*", "|") + "\nST|837|1\r\nCLM|c|2\n", HEAD.replace("*", "q") + ".STq837q1.CLMqdq3"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file string, content string")
    got = {}
    for r in parsers.segments(df).orderBy("file", "pos").collect():
        got.setdefault(r["file"], []).append(r["e"])
    assert [got["0"][1:], got["1"][1:], got["2"][1:]] == [
        [["ST", "837", "1"], ["CLM", "ab", "1"], ["SV1", " x"]],
        [["ST", "837", "1"], ["CLM", "c", "2"]],
        [["ST", "837", "1"], ["CLM", "d", "3"]],
    ]


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    from claimlake.operators.table import VersionedTable

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        VersionedTable(spark, str(tmp_path / "t")).upsert(spark.range(0, 400_000, 1, 8).selectExpr("id", "uuid() AS v"), ["id"], buckets=1)
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) > 1
    assert VersionedTable(spark, str(tmp_path / "t")).read().select("id").distinct().count() == 400_000


def test_tasks_of_claim_records_and_remittances_grow_with_the_lines(spark, sf_dir, monkeypatch):
    """With more lines than the session's partitions are for, there are more tasks, not larger ones."""
    from claimlake import queries, source_queries
    from claimlake.sources import mapped

    monkeypatch.setattr(mapped, "ROWS_PER_TASK", 600)
    monkeypatch.setattr(mapped, "LISTED_PER_TASK", 500)
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    tasks = lambda df: df.rdd.getNumPartitions()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are too large to broadcast
    try:
        assert tasks(source_queries._incoming(mapped.Mapped(spark, sf_dir))) == -(-n // 500) > 4
        assert tasks(queries.QUERIES["e3_dedup_remittances"](spark, sf_dir)) == -(-n // 600) > 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _claims(n: int, sep: str = "*", after: str = "") -> str:
    """An interchange of n claims, some with ids that look like headers, context that changes now and then, two HI each."""
    body = "ST*837*1*005010X222A1~NM1*85*2*C*****XX*N0~"
    for i in range(n):
        if i % 7 == 0:
            body += f"NM1*85*2*C*****XX*N{i}~"
        if i % 5 != 4:
            body += f"NM1*IL*1*D*J****MI*P{i}~NM1*PR*2*X*****PI*Y{i % 3}~"
        codes = "*".join(f"ABF:D{k}" for k in range(45))
        body += f"CLM*ISA{i}*{i + 1}.50***11:B:{1 + 6 * (i % 2)}~DTP*472*D8*202401{i % 28 + 1:02d}~HI*{codes}~HI*ABK:A{i}*none*ABF::x~" + "".join(f"LX*{k}~SV1*HC:9{i}{k}*{k}.00*UN*{k}~" for k in range(1, i % 4 + 1))
    return (HEAD + "~" + body + "SE*1*1~").replace("*", sep).replace("~", "~" + after)


def _shuffled_rows(spark, run) -> int:
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
    last = max((stages().apply(i).stageId() for i in range(stages().size())), default=-1)
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    found = [stages().apply(i) for i in range(stages().size())]
    return sum(x.shuffleWriteRecords() for x in found if x.stageId() > last)


def test_claims_shuffle_one_row_each_and_lines_too(spark):
    """Not a row a segment with all its elements."""
    df = spark.createDataFrame([(str(k), _claims(200)) for k in range(3)], "file string, content string")
    for got, n in zip(parsers.claims_837(df), (600, 900), strict=True):
        seen = []
        assert _shuffled_rows(spark, lambda got=got, seen=seen: seen.extend(got.collect())) <= 603
        assert len(seen) == n
    claim = parsers.claims_837(df)[0].where("claim_id = 'ISA9' and file = '1'").first()
    assert (claim["patient_id"], claim["provider_npi"], claim["payer_id"], claim["claim_seq"]) == ("P8", "N7", "Y2", 10)
    assert claim["diagnosis_codes"] == [f"D{k}" for k in range(45)] + ["A9", ""]


def test_claims_that_are_read_whole_lie_packed(spark, sf_dir):
    from claimlake import source_queries
    from claimlake.sources.mapped import Mapped

    m = Mapped(spark, sf_dir)
    plain = Path(source_queries._x12_claim_files(m).removeprefix("file://"))
    size = sum(p.stat().st_size for p in plain.rglob("*.txt"))
    whole = source_queries._x12_claims(m)
    names = whole.inputFiles()
    assert all(n.endswith(".gz") for n in names) and sum(Path(n.removeprefix("file://")).stat().st_size for n in names) < size / 4
    assert sorted(r["content"] for r in whole.collect()) == sorted(p.read_text() for p in plain.rglob("*.txt"))


def test_rendering_leaves_no_shuffle_files(spark, tmp_path, sf_dir):
    from claimlake.source_queries import _x12_claim_files
    from claimlake.sources.mapped import Mapped

    local = Path(spark.conf.get("spark.local.dir"))
    files_of = lambda: {p for p in local.rglob("shuffle_*") if p.is_file()}
    before = files_of()
    rows = spark.range(0, 20_000, 1, 4).selectExpr("id", "id % 7 AS file_no", "id % 2 AS folder")
    assert sinks.text_files(rows, str(tmp_path / "out"), ["id"], text=F.concat(F.lit("x"), "id")) == 14
    _x12_claim_files(Mapped(spark, sf_dir))
    left = lambda: sum(p.stat().st_size for p in files_of() - before if p.exists())
    for _ in range(50):  # they are removed beside what goes on
        if left() < 1000:
            break
        time.sleep(0.2)
    assert left() < 1000  # those of a count
    assert (tmp_path / "out/folder=1/3.txt").read_text().startswith("x3x17x31x45")


@pytest.mark.parametrize("size", ["300", "5000", "64k"])
def test_splits_of_any_files_equal_whole_ones(spark, tmp_path, size):
    """Breaks behind terminators, other separators beside what looks like a claim, ids that look like headers."""
    from claimlake.session import setting

    odd = (HEAD + "~ST*837*1~NM1*85*2*C*****XX*N~CLM*q*1***11:B:1~").replace("*", "|") + "CLM*x|y~HI|A:1~DTP|472|D8|20240101~CLM|r|2~HI|A:2~"
    for name, made in {"breaks": [_claims(150, after="\r\n"), _claims(40)], "plain": [_claims(150), _claims(40, after="\n"), odd, _claims(30, "|")]}.items():
        at = tmp_path / name
        at.mkdir()
        for i, text in enumerate(made):
            (at / f"{i}.edi").write_text(text, newline="")
        with setting(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="1"):
            split = parsers.split_segments(spark, str(at))
        whole = files.whole_texts(spark, str(at))
        for got, want in zip(parsers.claims_837(split), parsers.claims_837(whole), strict=True):
            assert sorted(map(repr, got.drop("file").collect())) == sorted(map(repr, want.drop("file").collect())) and got.count() > 150
        assert split.select("file", "block").distinct().count() >= {"300": 30, "5000": 4, "64k": 2}[size]  # of the files that are written like the first one listed
    assert parsers.claims_837(split)[0].where("claim_id = 'q'").first()["date_of_service"] == "20240101"
    assert parsers.segments(split).where("tag = 'SV1'").count() == parsers.segments(whole).where("tag = 'SV1'").count()
