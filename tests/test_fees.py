"""Fee versions where a payer, code and region has many of them."""

import datetime

from claimlake import queries


def test_every_part_row_is_a_fee_version(spark, tmp_path):
    rows = [(2 * i, "Brand#1", "T", 100.0 + i) for i in range(1, 31)] + [(1, "Brand#1", "T", 5.0)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_type string, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    run = lambda name: queries.QUERIES[name](spark, str(tmp_path))
    assert run("z16_median_rates").first()["contract_count"] == 31
    fees = sorted((r["valid_from"], r["valid_to"], float(r["rate"]), r["is_current"]) for r in run("t6_fee_schedule").collect() if r["payer_id"] == "MEDICARE")
    assert [f[2] for f in fees] == [100.0 + i for i in range(1, 31)] and [f[3] for f in fees] == [0] * 29 + [1]
    assert all(b[0] - a[1] == datetime.timedelta(1) for a, b in zip(fees, fees[1:]))
    assert [f[0] for f in fees[:7]] == [datetime.date(y, 1, 1) for y in range(1995, 2002)]
    merged = run("m2_scd2_merge").collect()
    assert len(merged) == 32 and all(r["valid_from"] <= r["valid_to"] for r in merged)
