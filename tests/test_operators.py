import datetime

import pytest
from pyspark.sql import functions as F

from claimlake.operators import ingest, merge, sinks
from claimlake.plans import analyses, design, quality, silver, workflow
from claimlake.sources import files, parsers

D = datetime.date


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_snapshot_diff_sees_inserts_updates_and_deletes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    events, state = merge.snapshot_diff(a, ["id"], None, "t")
    assert rows(events, "_cdc_operation") == [("I",)] * 3
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "n")], "id int, v string")
    events, _ = merge.snapshot_diff(b, ["id"], state, "t")
    assert rows(events, "row_pk", "_cdc_operation") == [('{"id":2}', "U"), ('{"id":3}', "D"), ('{"id":4}', "I")]
    none, _ = merge.snapshot_diff(a, ["id"], state, "t")
    assert none.count() == 0


def test_resolve_prefers_delete_on_a_tie(spark):
    t = datetime.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, "I", t, "a"), (1, "D", t, "b"), (2, "I", t, "c"), (2, "U", t, "d")], "id int, _cdc_operation string, _cdc_timestamp timestamp, v string")
    assert rows(merge.resolve_cdc(ev, ["id"]), "id", "v") == [(2, "d")]
    assert merge.resolve_cdc(ev.limit(0), ["id"]).count() == 0


def test_scd2_closes_the_day_before_and_null_equals_null(spark):
    h = spark.createDataFrame([("a", 1.0, None, D(2020, 1, 1), D(9999, 12, 31), 1), ("b", 2.0, None, D(2020, 1, 1), D(9999, 12, 31), 1)], "k string, rate double, note string, valid_from date, valid_to date, is_current int")
    s = spark.createDataFrame([("a", 1.5, None, D(2021, 1, 1)), ("b", 2.0, None, D(2021, 1, 1)), ("c", 9.0, "n", D(2021, 1, 1))], "k string, rate double, note string, effective_date date")
    out = merge.scd2_merge(h, s, ["k"], ["rate", "note"])
    assert rows(out, "k", "rate", "valid_to", "is_current", "merge_action") == [
        ("a", 1.0, D(2020, 12, 31), 0, "closed"),
        ("a", 1.5, D(9999, 12, 31), 1, "inserted"),
        ("b", 2.0, D(9999, 12, 31), 1, "unchanged"),
        ("c", 9.0, D(9999, 12, 31), 1, "inserted"),
    ]


@pytest.mark.parametrize("hot", [1_000_000, 7])
def test_as_of_lookup_equals_brute_force(spark, monkeypatch, hot):
    """Overlapping, nested, equal and backward versions, keys of two columns with nulls, hot keys cut by date."""
    import random

    monkeypatch.setattr(merge, "HOT_FACTS", hot)
    r = random.Random(4)
    day = lambda n: D(2020, 1, 1) + datetime.timedelta(days=n)
    versions = []
    for _ in range(120):
        a = r.randrange(60)
        versions.append((r.choice("abc"), r.choice([1, 2, None]), float(r.randrange(9)) if r.random() < 0.9 else None, day(a), day(a + r.choice([-1, 0, 1, 5, 40, 3000])), r.choice([0, 0, 0, 1, None])))
    facts = [(i, r.choice("aaabz"), r.choice([1, 1, 2, None]), day(r.randrange(-3, 70)) if r.random() < 0.95 else None) for i in range(200)]
    h = spark.createDataFrame(versions, "k string, m int, rate double, valid_from date, valid_to date, is_current int")
    f = spark.createDataFrame(facts, "id int, k string, m long, d date").repartition(3)
    low = lambda x: (x is not None, x if x is not None else 0)
    want = []
    for i, k, m, d in facts:
        valid = [v for v in versions if m is not None and d is not None and v[:2] == (k, m) and v[3] <= d <= v[4]]
        want.append((i, max(valid, key=lambda v: (low(v[5]), v[3], low(v[2])))[2] if valid else None))
    out = merge.as_of_lookup(f, h, ["k", "m"], "d", "rate")
    assert sorted((x["id"], x["rate"]) for x in out.collect()) == want
    assert out.columns == ["id", "k", "m", "d", "rate"]


def test_as_of_lookup_of_many_versions_makes_few_rows(spark):
    """3,000 versions a key: what goes into the sequence is facts and stretches."""
    h = spark.range(6000).selectExpr("id % 2 as k", "id as rate", "date_add(date'2000-01-01', cast(id div 2 as int)) as valid_from", "date'9999-12-31' as valid_to", "0 as is_current")
    f = spark.range(1000).selectExpr("id", "id % 2 as k", "timestamp_seconds(946684800 + id * 200000) as d").withColumn("d", F.to_date("d"))
    out = merge.as_of_lookup(f, h, ["k"], "d", "rate")
    got = {r["id"]: r["rate"] for r in out.collect()}
    assert got == {r["id"]: min((r["d"] - D(2000, 1, 1)).days, 2999) * 2 + r["k"] for r in f.collect()}
    plan = out._jdf.queryExecution().executedPlan()
    made = []

    def walk(node):
        if "Join" in node.nodeName():
            made.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            walk(node.plan())

    walk(plan)
    assert made and sum(made) <= 1000 + 2 * 6000 + 2


def test_as_of_lookup_picks_the_valid_version(spark):
    h = spark.createDataFrame([("a", 1.0, D(2020, 1, 1), D(2020, 12, 31), 0), ("a", 2.0, D(2021, 1, 1), D(9999, 12, 31), 1)], "k string, rate double, valid_from date, valid_to date, is_current int")
    f = spark.createDataFrame([(1, "a", D(2020, 6, 1)), (2, "a", D(2022, 1, 1)), (3, "a", D(2019, 1, 1)), (4, "z", D(2022, 1, 1))], "id int, k string, d date")
    assert [tuple(r) for r in merge.as_of_lookup(f, h, ["k"], "d", "rate").select("id", "rate").orderBy("id").collect()] == [(1, 1.0), (2, 2.0), (3, None), (4, None)]


def test_validation_messages(spark):
    c = spark.createDataFrame([("c1", D(2024, 1, 1), 10.0, [("99213",)], ["d"], "1", "p"), (None, None, 0.0, [(None,)], [], None, None)], "claim_id string, date_of_service date, total_billed double, lines array<struct<cpt_code:string>>, diagnosis_codes array<string>, provider_npi string, payer_id string")
    good, bad = ingest.split_valid(ingest.validate_claims(c), "s", "claim", "claim_id")
    assert good.count() == 1
    assert bad.first()["error_detail"] == "Missing claim_id; Missing date_of_service; Invalid total_billed: 0.0; Line 0: missing cpt_code"


def test_claim_actions_fold_a_batch(spark):
    known = spark.createDataFrame([("k", 5.0, "received")], "claim_id string, total_billed double, status string")
    lines = spark.createDataFrame([("k", 1, "99213")], "claim_id string, line_number int, cpt_code string")
    inc = spark.createDataFrame([("n", "1", 1, 7.0, [("1",)]), ("n", "7", 2, 8.0, [("2",)]), ("k", "8", 3, 0.0, [("3",)]), ("k", "1", 4, 0.0, [("4",)])], "claim_id string, frequency_code string, arrival int, total_billed double, lines array<struct<cpt_code:string>>")
    acted = ingest.claim_actions(inc, known)
    assert rows(acted, "arrival", "action") == [(1, "insert"), (2, "update"), (3, "void"), (4, "skip")]
    claims, new_lines = ingest.apply_claim_actions(known, lines, acted)
    assert rows(claims, "claim_id", "total_billed", "status") == [("k", 5.0, "voided"), ("n", 8.0, "corrected")]
    assert rows(new_lines, "claim_id", "cpt_code") == [("k", "99213"), ("n", "2")]


def test_a_replacement_after_a_void_counts(spark):
    known = spark.createDataFrame([("k", 5.0, "received"), ("v", 5.0, "received")], "claim_id string, total_billed double, status string")
    lines = spark.createDataFrame([("k", 1, "99213"), ("k", 2, "99214")], "claim_id string, line_number int, cpt_code string")
    schema = "claim_id string, frequency_code string, arrival int, total_billed double, lines array<struct<cpt_code:string>>"
    inc = spark.createDataFrame([("k", "8", 1, 0.0, [("1",)]), ("k", "7", 2, 6.0, [("2",)]), ("v", "7", 1, 7.0, [("3",)]), ("v", "8", 1, 0.0, [])], schema)
    claims, new_lines = ingest.apply_claim_actions(known, lines, ingest.claim_actions(inc, known))
    assert rows(claims, "claim_id", "total_billed", "status") == [("k", 6.0, "corrected"), ("v", 7.0, "voided")]
    assert rows(new_lines, "claim_id", "line_number", "cpt_code") == [("k", 1, "2"), ("v", 1, "3")]
    tie = spark.createDataFrame([("n", "1", 1, 2.0, []), ("n", "1", 1, 1.0, []), ("n", "7", 1, 3.0, [])], schema)
    for batch in (tie, tie.orderBy("total_billed"), tie.orderBy(F.desc("total_billed"))):
        acted = ingest.claim_actions(batch, known)
        assert sorted(r["action"] for r in acted.collect()) == ["insert", "skip", "update"]
        assert rows(ingest.apply_claim_actions(known, lines, acted)[0].where("claim_id = 'n'"), "total_billed", "status") == [(3.0, "corrected")]


def test_scd2_folds_staged_rows_and_keeps_unmarked_versions(spark):
    h = spark.createDataFrame([("a", 1.0, D(2020, 1, 1), D(9999, 12, 31), None), ("a", 0.5, D(2019, 1, 1), D(2019, 12, 31), 0)], "k string, rate double, valid_from date, valid_to date, is_current int")
    s = spark.createDataFrame([("a", 3.0, D(2022, 1, 1)), ("a", 2.0, D(2021, 1, 1)), ("a", 2.0, D(2021, 6, 1)), ("b", 1.0, D(2021, 1, 1)), ("b", 2.0, D(2022, 1, 1)), (None, 1.0, D(2021, 1, 1))], "k string, rate double, effective_date date")
    out = merge.scd2_merge(h, s, ["k"], ["rate"])
    got = sorted((r["k"] or "", r["rate"], r["valid_from"], r["valid_to"], r["is_current"], r["merge_action"]) for r in out.collect())
    end = D(9999, 12, 31)
    assert got == [
        ("", 1.0, D(2021, 1, 1), end, 1, "inserted"),
        ("a", 0.5, D(2019, 1, 1), D(2019, 12, 31), 0, "history"),
        ("a", 1.0, D(2020, 1, 1), D(2020, 12, 31), 0, "closed"),
        ("a", 2.0, D(2021, 1, 1), D(2021, 12, 31), 0, "inserted"),
        ("a", 3.0, D(2022, 1, 1), end, 1, "inserted"),
        ("b", 1.0, D(2021, 1, 1), D(2021, 12, 31), 0, "inserted"),
        ("b", 2.0, D(2022, 1, 1), end, 1, "inserted"),
    ]


def test_requests_are_taken_in_order(spark):
    cases = spark.createDataFrame([("CASE-1", "open", None, None), ("CASE-2", "closed", None, None)], "case_id string, status string, last_activity_date date, closed_date date")
    asked = spark.createDataFrame([("CASE-1", "closed", 3), ("CASE-1", "in_review", 2), ("CASE-1", "negotiation", 4), ("CASE-1", "closed", 1), ("CASE-2", "open", 1), ("CASE-9", "open", 1)], "case_id string, target_status string, arrival int")
    judged = workflow.judge_transitions(asked, cases)
    assert [(r["case_id"], r["target_status"], r["valid"]) for r in judged.orderBy("case_id", "step").collect()] == [("CASE-1", "closed", False), ("CASE-1", "in_review", True), ("CASE-1", "closed", True), ("CASE-1", "negotiation", False), ("CASE-2", "open", False), ("CASE-9", "open", False)]
    assert judged.where("case_id = 'CASE-9'").first()["reason"] == "Case CASE-9 not found"
    assert "allowed: none" in judged.where("case_id = 'CASE-2'").first()["reason"]
    assert rows(workflow.apply_transitions(cases, judged, "2024-01-01"), "case_id", "status") == [("CASE-1", "closed"), ("CASE-2", "closed")]


def test_diagnoses_beyond_forty(spark):
    codes = [f"D{i}" for i in range(60)]
    body = "ST*837*1*x~NM1*85*2*C*****XX*1~NM1*IL*1*D*J****MI*P1~CLM*C1*1***11:B:1~HI*" + "*".join(f"ABF:{c}" for c in codes) + "~NM1*IL*1*D*J****MI*P2~CLM*C2*1***11:B:1~SE*1*1~"
    claims, _ = parsers.claims_837(spark.createDataFrame([("a", x12(body))], "file string, content string"))
    got = {r["claim_id"]: r for r in claims.collect()}
    assert got["C1"]["diagnosis_codes"] == codes and (got["C1"]["patient_id"], got["C2"]["patient_id"]) == ("P1", "P2")


@pytest.mark.parametrize("size", ["400", "1500", "128m"])
def test_x12_in_splits_equals_whole_files(spark, tmp_path, size):
    """Claims across splits of any size, with context that changes now and then, and a file with another terminator."""
    body = "ST*837*1*005010X222A1~NM1*85*2*C*****XX*N0~"
    for i in range(60):
        if i % 7 == 0:
            body += f"NM1*85*2*C*****XX*N{i}~"
        if i % 5 != 4:
            body += f"NM1*IL*1*D*J****MI*P{i}~NM1*PR*2*X*****PI*Y{i % 3}~"
        body += f"CLM*C{i}*{i + 1}.50***11:B:{1 + 6 * (i % 2)}~DTP*472*D8*202401{i % 28 + 1:02d}~HI*ABK:A{i}*ABF:B{i}~" + "".join(f"LX*{k}~SV1*HC:9{i}{k}*{k}.00*UN*{k}~" for k in range(1, i % 4 + 1))
    (tmp_path / "a.edi").write_text(x12(body + "SE*1*1~"))
    (tmp_path / "b.edi").write_text(x12(body.replace("CLM*C", "CLM*Z") + "SE*1*1~"))
    (tmp_path / "odd.edi").write_text(x12(body).replace("~", "!"))
    (tmp_path / "none.edi").write_text("no interchange")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = parsers.split_segments(spark, str(tmp_path))
        whole = files.whole_texts(spark, f"{tmp_path}/[ab].edi")
        show = lambda df: sorted(map(repr, df.drop("file").collect()))
        for got, want in zip(parsers.claims_837(split), parsers.claims_837(whole), strict=True):
            assert show(got) == show(want) and got.count() >= 90
        assert size == "128m" or split.select("file", "block").distinct().count() > 6
        assert sorted(r["file"].rsplit("/", 1)[1] for r in parsers.odd_terminators(spark, str(tmp_path)).collect()) == ["none.edi", "odd.edi"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_splits_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    """Splits of 64 kB go many to a task, and claims and lines are those of whole files; lines know their claim without its head."""
    from claimlake import source_queries

    body = "ST*837*1*005010X222A1~NM1*85*2*C*****XX*N0~" + "".join(f"NM1*IL*1*D*J****MI*P{i}~CLM*{i}*1***11:B:1~HI*" + "*".join(["ABF:X"] * 300) + "~\r\nLX*1~SV1*HC:9*2.00*UN*3~" for i in range(900)) + "CLM~SV1*HC:8*1*UN*1~SE*1*1~"
    (tmp_path / "a.edi").write_text(x12(body))
    monkeypatch.setattr(source_queries, "SPLIT_TASK_BYTES", 1 << 20)
    m = type("M", (), {"spark": spark})()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    split = source_queries._in_splits(m, str(tmp_path))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before and spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    assert split.select("block").distinct().count() > 20
    written = {r[0] for r in split.select(F.col("_metadata.file_path")).distinct().collect()}
    assert len(written) <= 5
    whole = files.whole_texts(spark, f"{tmp_path}/a.edi")
    for got, want in zip(parsers.claims_837(split), parsers.claims_837(whole), strict=True):
        assert sorted(map(repr, got.drop("file").collect())) == sorted(map(repr, want.drop("file").collect())) and got.count() == 901
    assert parsers.claims_837(split)[1].where("claim_id is null and cpt_code = '8'").count() == 1


def test_means_are_exact(spark):
    from claimlake.functions import mean, share

    df = spark.createDataFrame([("0.01",), ("0.02",), ("-1.00",)], "v string").select(F.col("v").cast("decimal(18,2)").alias("v"))
    some = lambda cond: df.where(cond).agg(mean(F.sum("v"), F.count("*")).alias("m")).first()["m"]
    assert some("v > 0") == 0.02 and some("v < 0") == -1.0 and some("v > 5") is None
    thirds = df.where("v = 0.01").select(share(F.col("v"), F.lit(3)).alias("x")).first()["x"]
    assert str(thirds) == "0.003333"


def test_jdbc_rows_after_a_watermark(spark):
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    try:
        spark._jvm.java.lang.Class.forName(driver)
    except Exception:
        pytest.skip("no database in this installation")
    url = "jdbc:derby:memory:claims;create=true"
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01")], "id int, day string").write.jdbc(url, "t", properties={"driver": driver})
    assert files.jdbc_table(spark, url, "t", driver=driver).count() == 2
    late = files.jdbc_table(spark, url, "t", "id", 1, driver=driver)
    assert [r["ID" if "ID" in late.columns else "id"] for r in late.collect()] == [2]
    assert "PushedFilters: [*IsNotNull(id), *GreaterThan(id,1)]" in late._jdf.queryExecution().toString().replace("ID", "id")


def test_matching_cascade(spark):
    claims = spark.createDataFrame([("C1",), ("77ab",), ("zz",)], "claim_id string")
    alias = spark.createDataFrame([("odd", "p", "zz")], "payer_claim_id string, payer_id string, claim_id string")
    r = spark.createDataFrame([("C1", "p"), ("00077AB", "p"), ("odd", "p"), ("none", "p")], "payer_claim_id string, payer_id string")
    assert rows(ingest.match_claims(r, claims, alias).fillna(""), "payer_claim_id", "claim_id", "matched_by") == [("00077AB", "77ab", "normalised"), ("C1", "C1", "exact"), ("none", "", ""), ("odd", "zz", "alias")]


def test_backfill_outcomes_and_crosswalk(spark):
    schema = "claim_id string, date_of_service date, provider_npi string, total_billed double"
    old = spark.createDataFrame([("a", D(2020, 1, 1), None, 1.0), ("b", D(2020, 1, 1), "n", 1.0)], schema)
    new = spark.createDataFrame([("a", D(2020, 1, 1), None, 1.0), ("b", D(2020, 1, 1), "n", 2.0), ("c", D(2020, 1, 1), "n", 2.0)], schema)
    assert rows(ingest.backfill_dedup(new, old), "claim_id", "outcome") == [("a", "duplicate"), ("b", "conflict"), ("c", "new")]
    claims = spark.createDataFrame([("a", "OLD", [("x1", 1), ("y", 2)]), ("b", "P", [])], "claim_id string, payer_id string, lines array<struct<cpt_code:string,units:int>>")
    xw = spark.createDataFrame([("x1", "99213", "s"), ("OLD", "NEW", "s")], "legacy_code string, standard_code string, source_system string")
    out = {r["claim_id"]: r for r in ingest.apply_crosswalk(claims, xw).collect()}
    assert [x["cpt_code"] for x in out["a"]["lines"]] == ["99213", "y"]
    assert (out["a"]["payer_id"], out["a"]["mapping_status"], out["b"]["mapping_status"], out["b"]["lines"]) == ("NEW", "mapped", "unchanged", [])


def x12(body):
    isa = "ISA*00*          *00*          *ZZ*SENDER         *ZZ*RECEIVER       *240101*1200*^*00501*000000001*0*P*:~"
    assert isa[105] == "~"
    return isa + body


def test_837_claims_and_lines(spark):
    body = "ST*837*0001*005010X222A1~NM1*85*2*CLINIC*****XX*1234567890~NM1*IL*1*DOE*JOHN****MI*PAT1~NM1*PR*2*AETNA*****PI*AET~CLM*C100*250.5***11:B:7~DTP*472*D8*20240115~HI*ABK:J06*ABF:R05~LX*1~SV1*HC:99213:25*150.5*UN*1~SV1*HC:87880*100*UN*2~CLM*C101*80***11:B~DTP*472*D8*20240116~SV1*HC:99212*80*UN~SE*1*1~"
    f = spark.createDataFrame([("a.edi", x12(body)), ("bad.edi", "hello")], "file string, content string")
    claims, lines = parsers.claims_837(f)
    got = {r["claim_id"]: r for r in claims.collect()}
    assert (got["C100"]["frequency_code"], got["C101"]["frequency_code"]) == ("7", "1")
    assert (got["C100"]["patient_id"], got["C100"]["provider_npi"], got["C101"]["payer_id"], got["C100"]["date_of_service"]) == ("PAT1", "1234567890", "AET", "20240115")
    assert got["C100"]["diagnosis_codes"] == ["J06", "R05"] and float(got["C100"]["total_billed"]) == 250.5
    assert rows(lines, "claim_id", "line_number", "cpt_code", "modifier", "units") == [("C100", 1, "99213", "25", 1), ("C100", 2, "87880", "", 2), ("C101", 1, "99212", "", 1)]
    assert rows(parsers.rejected(f), "file") == [("bad.edi",)]


def test_835_remittances(spark):
    body = "ST*835*1~TRN*1*TR9~DTM*405*20240201~N1*PR*AETNA*XX*AET~CLP*C100*1*250*200*10~CAS*CO*45*30**97*10~CAS*PR*1*10~SVC*HC:99213*150*120~CLP*C101*4*80*0~CAS*CO*50*80~SE*1*1~"
    out = {r["payer_claim_id"]: r for r in parsers.remittances_835(spark.createDataFrame([("e", x12(body))], "file string, content string")).collect()}
    assert [a["reason_code"] for a in out["C100"]["adjustments"]] == ["45", "97", "1"]
    assert (out["C100"]["trace_number"], out["C100"]["payer_id"], out["C100"]["denial_code"], out["C101"]["denial_code"]) == ("TR9", "AET", None, "50")
    assert out["C100"]["service_lines"][0]["cpt_code"] == "99213"


def test_hl7_and_eob(spark):
    msg = "MSH|^~\\&|A|B|C|D|20240101||ADT^A01|1|P|2.5\rPID|1||P7^^^H||DOE^JANE^Q||19800102|F|||1 ST^^TOWN^TX^75001\rIN1|1|INS9\rMSH|^~\\&|A|B|C|D|1||ORU^R01|1\rPID|1||P8"
    good, bad = parsers.patients_hl7(parsers.hl7_messages(spark.createDataFrame([("f", msg)], "file string, content string")))
    r = good.first()
    assert (r["patient_id"], r["first_name"], r["last_name"], r["dob"], r["gender"], r["city"], r["zip"], r["insurance_id"]) == ("P7", "JANE Q", "DOE", D(1980, 1, 2), "female", "TOWN", "75001", "INS9")
    assert bad.count() == 1
    e = spark.createDataFrame([("s", "p", {"Claim_No": ("C1", 0.9), "AmountPaid": (None, 0.1)}, 0.95)], "source_file string, payer_id string, fields map<string,struct<value:string,confidence:double>>, avg_confidence double")
    f = parsers.eob_fields(e).first()
    assert (f["claim_number"], f["claim_number_confidence"], f["paid_amount"], f["paid_amount_confidence"]) == ("C1", 0.9, None, 0.0)


def test_chunks_have_overlap_and_titles(spark):
    text = "intro words\nSection 1. One\nalpha beta\nSection 2. Two\ngamma"
    out = parsers.chunks(spark.createDataFrame([("f", text, "45 CFR"), ("g", "no headers", "x")], "file string, content string, cfr_citation string"))
    assert rows(out.where("file = 'f'"), "section_index", "section_title")[0] == (0, "Preamble")
    assert rows(out.where("file = 'g'"), "section_title") == [("Full Document",)]
    assert "alpha beta" in out.where("section_title like 'Section 2%'").first()["chunk_text"]


def test_readers(spark, tmp_path):
    (tmp_path / "fee.csv").write_text("cpt_code,modifier,geo_region,rate,rate_type,effective_date\n 99213 ,,TX,10.5,medicare,2024-01-01\n99214,26,TX,bad,medicare,20240101\n")
    got = files.fee_csv(spark, str(tmp_path / "fee.csv")).collect()
    assert got[0]["cpt_code"] == "99213" and float(got[0]["rate"]) == 10.5 and got[1]["rate"] is None and got[1]["effective_date"] == D(2024, 1, 1)
    (tmp_path / "bf.csv").write_text("claim_id,patient_id,provider_npi,payer_id,date_of_service,total_billed,cpt_codes,diagnosis_codes\nB1,P,N,Y,2024-01-01,100,a;b;c,d1;d2\n")
    b = files.backfill_csv(spark, str(tmp_path / "bf.csv")).first()
    assert [float(x["billed_amount"]) for x in b["lines"]] == [33.33] * 3 and b["diagnosis_codes"] == ["d1", "d2"]
    assert files.table_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    drift = {r["column_name"]: (r["state"], r["misfit_rate"]) for r in files.drift(spark, str(tmp_path / "fee.csv"), {"rate": "double", "gone": "int"}).collect()}
    assert drift["rate"] == ("present", 0.5) and drift["gone"][0] == "missing" and drift["cpt_code"][0] == "unexpected"


def test_gold_counts(spark, tmp_path):
    assert sinks.write_gold(spark.range(5), str(tmp_path / "g"))["rows"] == 5


def test_silver_edges(spark):
    claims = spark.createDataFrame([("a",)], "claim_id string")
    lines = spark.createDataFrame([], "claim_id string, cpt_code string, units int")
    r = silver.claims(claims, lines).first()
    assert (r["line_count"], r["cpt_codes"], r["total_units"]) == (0, [], 0)
    out, failed = silver.refresh({"patients": spark.createDataFrame([], "patient_id string")})
    assert out == {} and len(failed) == 9


def test_workflow_and_design(spark):
    assert workflow.transition_rules(spark).count() == 10
    days = spark.createDataFrame([(D(2024, 1, 5),)], "d date").select(design.add_business_days(F.col("d"), 4).alias("x")).first()["x"]
    assert days == D(2024, 1, 11)
    with pytest.raises(KeyError, match="executive_summary"):
        analyses.run_analysis("nope", {})
    p = {r["column_name"]: r for r in quality.profile(spark.createDataFrame([(1, None), (2, "x")], "a int, b string")).collect()}
    assert p["b"]["null_rate"] == 0.5 and p["a"]["row_count"] == 2
