"""The queries of HEADLINE, held against DuckDB on the smallest tables; the others' SQL is held against them by the driver."""

import datetime
import decimal
import os

import duckdb
import pytest

from claimlake import feed_queries, queries, source_queries  # noqa: F401  the others register their queries too


def plain(v):
    if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool):
        return round(float(v), 3)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    return con


HEADLINE = ["c4_resolve_cdc", "c1_snapshot_diff", "m2_scd2_merge", "g2b_rate_as_of", "t3_claims", "g1_recovery_by_payer", "g5_claims_aging", "g9_win_loss", "g13_monthly_trends", "w8_monitor", "w9_transitions", "q4_consistency", "z4_business_days", "g2_cpt_analysis", "z6_award_spread", "e2_apply_actions", "e2_apply_lines", "m3_provider_scd2", "p1_claims_837", "p2_remittances_835", "w9_apply", "w9_deadlines", "q1_orphans", "p9_chunks", "s4_crosswalk_csv", "st5_claims_with_remittances", "z5_recovery_cube", "k2_snapshots", "st1_replayed", "st6_replayed", "st7_incremental", "z1_decisions", "c1_ranged_diff", "p1_claims_split", "q6_frequent_values", "w11_windowed_alerts", "q2_coverage", "z16_median_rates", "w2_cases", "g10_analyst_productivity", "s11_jdbc_incremental", "st2_stateful_lines"]


@pytest.mark.parametrize("name", HEADLINE)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    rel = duck.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == columns
    want = sorted(repr([plain(dict(zip(rel.columns, r, strict=True))[c]) for c in columns]) for r in rel.fetchall())
    assert got == want


def test_every_oracle_belongs_to_a_query():
    assert set(queries.ORACLES) <= set(queries.QUERIES)
