"""Registered queries of the analytic library over the given tables, and independent SQL for each."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import money, plain
from .operators import ingest, merge
from .operators.digests import SnapshotState
from .operators.text_index import ChunkIndex
from .plans import analyses, design, gold, measures, quality, reports, silver, workflow
from .session import scratch
from .sources import mapped, parsers, workload
from .sources.mapped import AS_OF, Mapped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# ---- the mapped tables in SQL, as common table expressions

_CTE = {
    "m_payers": "SELECT CAST(n_nationkey AS BIGINT) AS payer_id, n_name AS name, CASE n_regionkey % 3 WHEN 0 THEN 'commercial' WHEN 1 THEN 'medicare' ELSE 'medicaid' END AS type, r_name AS state FROM nation JOIN region ON n_regionkey = r_regionkey",
    "m_providers": "SELECT s_suppkey AS npi, s_name AS name, CASE s_suppkey % 4 WHEN 0 THEN 'Radiology' WHEN 1 THEN 'Cardiology' WHEN 2 THEN 'Anesthesiology' ELSE 'Emergency' END AS specialty, n_name AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "m_lines": "SELECT l_orderkey AS claim_id, CAST(l_linenumber AS BIGINT) AS line_number, p_brand AS cpt_code, p_type AS geo_region, CAST(l_quantity AS BIGINT) AS units, CAST(l_extendedprice AS DECIMAL(18,2)) AS billed_amount FROM lineitem JOIN part ON l_partkey = p_partkey",
    "m_claims": "SELECT o_orderkey AS claim_id, o_custkey AS patient_id, m.npi AS provider_npi, CAST(c_nationkey AS BIGINT) AS payer_id, CAST(o_orderdate AS DATE) AS date_of_service, CAST(o_totalprice AS DECIMAL(18,2)) AS total_billed, CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'filed' ELSE 'underpaid' END AS status FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS npi FROM lineitem GROUP BY l_orderkey) m ON m.l_orderkey = o_orderkey",
    "m_remits": "SELECT l_orderkey AS claim_id, CAST(l_linenumber AS BIGINT) AS trace_number, CAST(l_shipdate AS DATE) AS era_date, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS paid_amount, CAST(l_extendedprice AS DECIMAL(18,2)) AS allowed_amount, CASE l_returnflag WHEN 'R' THEN '50' WHEN 'A' THEN '' ELSE NULL END AS denial_code FROM lineitem WHERE l_linestatus = 'F'",
    "m_fees": "SELECT payer_id, cpt_code, geo_region, rate, id, CAST(make_date(CAST(1994 + least(v, 7) AS INT), 1, 1) + CAST(greatest(v - 7, 0) AS INT) AS DATE) AS valid_from, v FROM (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'MEDICARE' ELSE 'FAIR_HEALTH' END AS payer_id, p_brand AS cpt_code, p_type AS geo_region, CAST(p_retailprice AS DECIMAL(18,2)) AS rate, p_partkey AS id, row_number() OVER (PARTITION BY p_partkey % 2, p_brand, p_type ORDER BY p_partkey) AS v FROM part) t",
    "h_fees": "SELECT *, coalesce(lead(valid_from) OVER w - 1, DATE '9999-12-31') AS valid_to, CASE WHEN lead(valid_from) OVER w IS NULL THEN 1 ELSE 0 END AS is_current FROM m_fees WINDOW w AS (PARTITION BY payer_id, cpt_code, geo_region ORDER BY valid_from)",
    "r1": "SELECT claim_id, sum(paid_amount) AS paid, sum(allowed_amount) AS allowed, count(*) AS n, max(CASE WHEN denial_code IS NOT NULL AND denial_code <> '' THEN 1 ELSE 0 END) AS denied FROM m_remits GROUP BY claim_id",
    "cr": "SELECT c.claim_id, c.payer_id, p.name AS payer_name, c.provider_npi, c.date_of_service, c.status, c.total_billed, coalesce(r.paid, 0) AS total_paid, coalesce(r.allowed, 0) AS total_allowed, c.total_billed - coalesce(r.paid, 0) AS underpayment, coalesce(r.n, 0) AS remittance_count, coalesce(r.denied, 0) AS has_denial FROM m_claims c LEFT JOIN r1 r ON c.claim_id = r.claim_id LEFT JOIN m_payers p ON c.payer_id = p.payer_id",
    "dsp": "SELECT 'DSP-' || claim_id AS dispute_id, claim_id, 'CASE-' || claim_id AS case_id, CASE WHEN total_paid > 0 THEN 'underpayment' ELSE 'denial' END AS dispute_type, payer_id, payer_name, provider_npi, total_billed AS billed_amount, total_paid AS paid_amount, underpayment AS underpayment_amount, CAST(CASE WHEN total_allowed > 0 THEN total_allowed ELSE round(total_billed * CAST(0.6 AS DECIMAL(4,2)), 2) END AS DECIMAL(18,2)) AS qpa_amount, date_of_service + CAST(claim_id % 60 AS INT) AS filed_date FROM cr WHERE underpayment > 0",
    "cs0": "SELECT case_id, claim_id AS n, CASE WHEN underpayment_amount > 500 THEN 'analyst_kpatel' WHEN underpayment_amount > 200 THEN 'analyst_mchen' ELSE 'analyst_jsmith' END AS assigned_analyst, ['open', 'in_review', 'negotiation', 'idr_initiated', 'idr_submitted', 'decided', 'closed'][claim_id % 7 + 1] AS status, CASE WHEN underpayment_amount > 500 THEN 'high' WHEN underpayment_amount > 200 THEN 'medium' ELSE 'low' END AS priority, filed_date AS created_date, underpayment_amount FROM dsp",
    "cs": "SELECT *, created_date + CAST(n % 30 AS INT) AS last_activity_date, CASE WHEN n % 7 >= 5 THEN created_date + CAST(30 + n % 90 AS INT) END AS closed_date, CASE WHEN n % 7 >= 5 AND n % 4 < 3 THEN ['won', 'lost', 'settled'][n % 4 + 1] END AS outcome, CASE WHEN n % 7 >= 5 AND n % 4 = 0 THEN underpayment_amount END AS award_amount FROM cs0",
    "dl": "SELECT d.case_id, d.dispute_id, t.deadline_type, d.filed_date + t.days AS due_date, CASE d.claim_id % 5 WHEN 0 THEN 'met' WHEN 1 THEN 'missed' ELSE 'pending' END AS status FROM dsp d CROSS JOIN (VALUES ('open_negotiation', 30), ('idr_initiation', 34), ('idr_decision', 64)) t(deadline_type, days)",
    "sdl": "SELECT *, CASE WHEN status NOT IN ('met', 'missed') THEN CAST(due_date - DATE '2001-08-01' AS BIGINT) END AS days_remaining, CASE WHEN status NOT IN ('met', 'missed') AND due_date - DATE '2001-08-01' <= 5 THEN 1 ELSE 0 END AS is_at_risk FROM dl",
    "dlc": "SELECT *, CASE WHEN status = 'met' AND dayofmonth(due_date) > 3 THEN due_date END AS completed_date FROM dl",
    "m_cdc": "SELECT event_id AS seq, ts, user_id AS row_pk, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op, value, props FROM events",
    "scl": "SELECT c.claim_id, c.total_billed, coalesce(l.line_count, 0) AS line_count, coalesce(l.codes, []) AS codes, coalesce(l.units, 0) AS total_units FROM m_claims c LEFT JOIN (SELECT claim_id, count(*) AS line_count, list_sort(list(DISTINCT cpt_code)) AS codes, sum(units) AS units FROM m_lines GROUP BY claim_id) l ON c.claim_id = l.claim_id",
}


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN CAST({b} AS DOUBLE) > 0 THEN round(coalesce(CAST({a} AS DOUBLE), 0) * 100.0 / CAST({b} AS DOUBLE), 2) ELSE 0.0 END"


def _mean(total: str, n: str) -> str:
    """A sum of amounts over a count, rounded half away from zero to cents, in integers."""
    s = f"CAST({total} * 100 AS HUGEINT)"
    return f"CASE WHEN {n} > 0 THEN CASE WHEN {total} < 0 THEN -((2 * -{s} + {n}) // (2 * {n})) ELSE (2 * {s} + {n}) // (2 * {n}) END / 100.0 END"


def _mean_share(total: str, n: str) -> str:
    """The same for a sum of millionths that isn't negative."""
    return f"(2 * CAST({total} AS HUGEINT) + 10000 * {n}) // (20000 * {n}) / 100.0"


def _share(amount: str, n: str) -> str:
    """An n-th of a decimal amount, to a millionth."""
    return f"CAST(((2 * CAST({amount} * 1000000 AS HUGEINT) + {n}) // (2 * {n})) AS DECIMAL(24,0))"


def _cents(total: str) -> str:
    """A sum of millionths that isn't negative, in cents rounded, as an amount."""
    return f"(CAST({total} AS HUGEINT) + 5000) // 10000 / 100.0"


_CTE |= {
    "g1": f"SELECT payer_id, max(payer_name) AS payer_name, count(*) AS total_claims, CAST(sum(total_billed) AS DOUBLE) AS total_billed, CAST(sum(total_paid) AS DOUBLE) AS total_paid, CAST(sum(underpayment) AS DOUBLE) AS total_underpayment, round(coalesce(avg(CASE WHEN total_billed > 0 THEN CAST(total_paid AS DOUBLE) * 100.0 / CAST(total_billed AS DOUBLE) END), 0), 2) AS avg_payment_pct, CAST(sum(has_denial) AS BIGINT) AS denial_count, {_pct('sum(total_paid)', 'sum(total_billed)')} AS recovery_rate_pct, {_pct('sum(has_denial)', 'count(*)')} AS denial_rate_pct FROM cr WHERE payer_id IS NOT NULL GROUP BY payer_id",
    "g2s": f"SELECT unnest(s.codes) AS cpt_code, {_share('s.total_billed', 'len(s.codes)')} AS b, {_share('cr.total_paid', 'len(s.codes)')} AS p FROM scl s JOIN cr ON s.claim_id = cr.claim_id WHERE len(s.codes) > 0",
    "rate1": "SELECT payer_id, cpt_code, CAST(rate AS DOUBLE) AS rate FROM (SELECT *, row_number() OVER (PARTITION BY payer_id, cpt_code ORDER BY geo_region, id) AS k FROM h_fees WHERE is_current = 1) t WHERE k = 1",
    "g2": f"SELECT a.*, {_pct('a.total_paid', 'a.total_billed')} AS payment_ratio_pct, m.rate AS medicare_rate, f.rate AS fair_health_rate FROM (SELECT cpt_code, count(*) AS claim_count, {_cents('sum(b)')} AS total_billed, {_cents('sum(p)')} AS total_paid, {_mean_share('sum(b)', 'count(*)')} AS avg_billed, {_mean_share('sum(p)', 'count(*)')} AS avg_paid FROM g2s GROUP BY cpt_code) a LEFT JOIN rate1 m ON m.cpt_code = a.cpt_code AND m.payer_id = 'MEDICARE' LEFT JOIN rate1 f ON f.cpt_code = a.cpt_code AND f.payer_id = 'FAIR_HEALTH'",
    "g3a": f"SELECT payer_id, max(payer_name) AS payer_name, count(*) AS total_claims, {_pct('sum(total_paid)', 'sum(total_billed)')} AS payment_rate_pct, {_pct('sum(has_denial)', 'count(*)')} AS denial_rate_pct, {_mean('sum(underpayment)', 'count(*)')} AS avg_underpayment, CAST(sum(underpayment) AS DOUBLE) AS total_underpayment FROM cr WHERE payer_id IS NOT NULL GROUP BY payer_id",
    "g3": "SELECT g3a.*, CASE WHEN payment_rate_pct >= 80 AND denial_rate_pct <= 10 THEN 'low' WHEN payment_rate_pct >= 50 OR denial_rate_pct <= 30 THEN 'medium' ELSE 'high' END AS risk_tier, p.type AS payer_type, CAST(NULL AS DOUBLE) AS avg_days_to_pay FROM g3a LEFT JOIN m_payers p ON p.payer_id = g3a.payer_id",
    "g4w": f"SELECT CAST(count(*) AS DOUBLE) AS total_claims, CAST(sum(total_billed) AS DOUBLE) AS total_billed, CAST(sum(total_paid) AS DOUBLE) AS total_paid, CAST(sum(underpayment) AS DOUBLE) AS total_underpayment, {_pct('sum(total_paid)', 'sum(total_billed)')} AS recovery_rate_pct, CAST(count(*) FILTER (WHERE total_paid > 0) AS DOUBLE) AS paid_claims, CAST(sum(has_denial) AS DOUBLE) AS denial_count, {_pct('sum(has_denial)', 'count(*)')} AS denial_rate_pct, {_mean('sum(total_billed)', 'count(*)')} AS avg_billed_per_claim, {_mean('sum(underpayment)', 'count(*)')} AS avg_underpayment_per_claim FROM cr",
    "g4": "SELECT metric_name, metric_value FROM (UNPIVOT g4w ON COLUMNS(*) INTO NAME metric_name VALUE metric_value)",
    "g5": "SELECT aging_bucket, count(*) AS claim_count, CAST(sum(total_billed) AS DOUBLE) AS total_billed, CAST(sum(underpayment) AS DOUBLE) AS total_unpaid, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct_of_total FROM (SELECT *, CASE WHEN DATE '2001-08-01' - date_of_service <= 30 THEN '0-30 days' WHEN DATE '2001-08-01' - date_of_service <= 60 THEN '31-60 days' WHEN DATE '2001-08-01' - date_of_service <= 90 THEN '61-90 days' WHEN DATE '2001-08-01' - date_of_service <= 180 THEN '91-180 days' ELSE '180+ days' END AS aging_bucket FROM cr WHERE date_of_service IS NOT NULL) t GROUP BY aging_bucket",
    "scs": "SELECT cs.*, d.n_d AS dispute_count, d.b AS total_billed, d.u AS total_underpayment, CAST(DATE '2001-08-01' - created_date AS BIGINT) AS age_days FROM cs JOIN (SELECT case_id, count(*) AS n_d, sum(billed_amount) AS b, sum(underpayment_amount) AS u FROM dsp GROUP BY case_id) d ON d.case_id = cs.case_id",
    "g6": f"SELECT a.*, coalesce(b.sla, 0.0) AS sla_compliance_pct FROM (SELECT status, count(*) AS case_count, CAST(sum(total_billed) AS DOUBLE) AS total_billed, CAST(sum(total_underpayment) AS DOUBLE) AS total_underpayment, round(avg(age_days), 1) AS avg_age_days FROM scs GROUP BY status) a LEFT JOIN (SELECT c.status, {_pct('count(*) FILTER (WHERE l.status = ' + chr(39) + 'met' + chr(39) + ')', 'count(*)')} AS sla FROM cs c JOIN dl l ON l.case_id = c.case_id GROUP BY c.status) b ON a.status = b.status",
    "g7": f"SELECT deadline_type, count(*) AS total_deadlines, count(*) FILTER (WHERE status = 'met') AS met_count, count(*) FILTER (WHERE status = 'missed') AS missed_count, count(*) FILTER (WHERE status = 'pending') AS pending_count, CAST(sum(is_at_risk) AS BIGINT) AS at_risk_count, {_pct('count(*) FILTER (WHERE status = ' + chr(39) + 'met' + chr(39) + ')', 'count(*)')} AS compliance_pct FROM sdl GROUP BY deadline_type",
    "g8": f"SELECT dispute_id, claim_id, case_id, payer_id, payer_name, dispute_type, CAST(billed_amount AS DOUBLE) AS billed_amount, CAST(paid_amount AS DOUBLE) AS paid_amount, CAST(underpayment_amount AS DOUBLE) AS underpayment_amount, {_pct('underpayment_amount', 'billed_amount')} AS underpayment_pct, CAST(qpa_amount AS DOUBLE) AS qpa_amount, CAST(CASE WHEN {_pct('underpayment_amount', 'billed_amount')} > 25 AND billed_amount > coalesce(qpa_amount, 0) THEN 1 ELSE 0 END AS BIGINT) AS arbitration_eligible FROM dsp WHERE underpayment_amount > 0",
    "g9a": f"SELECT d.payer_id, d.payer_name, d.dispute_type, c.outcome, count(*) AS case_count, CAST(sum(d.billed_amount) AS DOUBLE) AS total_billed, CAST(sum(d.underpayment_amount) AS DOUBLE) AS total_disputed, coalesce(CAST(sum(c.award_amount) AS DOUBLE), 0.0) AS total_awarded, {_mean('sum(coalesce(c.award_amount, 0))', 'count(*)')} AS avg_award FROM cs c JOIN dsp d ON d.case_id = c.case_id WHERE c.status IN ('decided', 'closed') GROUP BY ALL",
    "g9": f"SELECT *, {_pct('sum(CASE WHEN outcome = ' + chr(39) + 'won' + chr(39) + ' THEN case_count ELSE 0 END) OVER w', 'sum(case_count) OVER w')} AS win_rate_pct, {_pct('total_awarded', 'total_disputed')} AS recovery_roi_pct FROM g9a WINDOW w AS (PARTITION BY payer_id, dispute_type)",
    "g10": f"SELECT assigned_analyst, count(*) AS total_cases, count(*) FILTER (WHERE status NOT IN ('closed', 'decided')) AS active_cases, count(*) FILTER (WHERE status IN ('closed', 'decided')) AS resolved_cases, count(*) FILTER (WHERE outcome = 'won') AS won_cases, count(*) FILTER (WHERE outcome = 'lost') AS lost_cases, count(*) FILTER (WHERE outcome = 'settled') AS settled_cases, {_pct('count(*) FILTER (WHERE outcome = ' + chr(39) + 'won' + chr(39) + ')', 'count(*) FILTER (WHERE status IN (' + chr(39) + 'closed' + chr(39) + ', ' + chr(39) + 'decided' + chr(39) + '))')} AS win_rate_pct, coalesce(CAST(sum(award_amount) AS DOUBLE), 0.0) AS total_recovered, CAST(sum(underpayment_amount) AS DOUBLE) AS total_disputed, round(avg(closed_date - created_date), 1) AS avg_resolution_days, count(*) FILTER (WHERE priority = 'critical') AS critical_cases, count(*) FILTER (WHERE priority = 'high') AS high_priority_cases FROM cs GROUP BY assigned_analyst",
    "g11": f"SELECT status, priority, count(*) AS case_count, round(avg(coalesce(closed_date, DATE '2001-08-01') - created_date), 1) AS avg_days, CAST(min(coalesce(closed_date, DATE '2001-08-01') - created_date) AS BIGINT) AS min_days, CAST(max(coalesce(closed_date, DATE '2001-08-01') - created_date) AS BIGINT) AS max_days, CAST(sum(underpayment_amount) AS DOUBLE) AS total_at_stake, coalesce(CAST(sum(award_amount) AS DOUBLE), 0.0) AS total_recovered, {_pct('count(*) FILTER (WHERE outcome = ' + chr(39) + 'won' + chr(39) + ')', 'count(*)')} AS win_rate_pct FROM cs GROUP BY status, priority",
    "g12": f"SELECT p.npi AS provider_npi, p.name AS provider_name, p.specialty, c.n AS total_claims, coalesce(d.n, 0) AS total_disputes, c.b AS total_billed, c.p AS total_paid, c.u AS total_underpayment, {_pct('c.p', 'c.b')} AS payment_rate_pct, {_pct('coalesce(d.n, 0)', 'c.n')} AS dispute_rate_pct, coalesce(d.won, 0.0) AS total_recovered FROM m_providers p JOIN (SELECT provider_npi, count(DISTINCT claim_id) AS n, CAST(sum(total_billed) AS DOUBLE) AS b, CAST(sum(total_paid) AS DOUBLE) AS p, CAST(sum(underpayment) AS DOUBLE) AS u FROM cr GROUP BY 1) c ON c.provider_npi = p.npi LEFT JOIN (SELECT provider_npi, count(DISTINCT dispute_id) AS n, CAST(sum(award_amount) AS DOUBLE) AS won FROM dsp JOIN cs ON cs.case_id = dsp.case_id GROUP BY 1) d ON d.provider_npi = p.npi",
    "g13": f"SELECT coalesce(a.month, b.month, c.month) AS month, coalesce(claim_count, 0) AS claim_count, coalesce(a.b, 0) AS total_billed, coalesce(a.p, 0) AS total_paid, coalesce(a.u, 0) AS total_underpayment, coalesce(denial_count, 0) AS denial_count, coalesce(new_disputes, 0) AS new_disputes, coalesce(resolved_cases, 0) AS resolved_cases, coalesce(total_awarded, 0) AS total_awarded, {_pct('coalesce(a.p, 0)', 'coalesce(a.b, 0)')} AS recovery_rate_pct FROM (SELECT strftime(date_of_service, '%Y-%m') AS month, count(*) AS claim_count, CAST(sum(total_billed) AS DOUBLE) AS b, CAST(sum(total_paid) AS DOUBLE) AS p, CAST(sum(underpayment) AS DOUBLE) AS u, CAST(sum(has_denial) AS BIGINT) AS denial_count FROM cr GROUP BY 1) a FULL JOIN (SELECT strftime(filed_date, '%Y-%m') AS month, count(*) AS new_disputes FROM dsp GROUP BY 1) b ON a.month = b.month FULL JOIN (SELECT strftime(closed_date, '%Y-%m') AS month, count(*) AS resolved_cases, CAST(sum(award_amount) AS DOUBLE) AS total_awarded FROM cs WHERE closed_date IS NOT NULL GROUP BY 1) c ON coalesce(a.month, b.month) = c.month",
}


def sql(body: str) -> str:
    """``body`` behind the common table expressions that it needs."""
    import re

    need: list[str] = []

    def visit(text: str) -> None:
        for name in _CTE:
            if name not in need and re.search(rf"\b{name}\b", text):
                visit(_CTE[name])
                need.append(name)

    visit(body)
    return "WITH " + ", ".join(f"{n} AS ({_CTE[n]})" for n in need) + " " + body if need else body


CTE = _CTE


def query(name: str, oracle: str | None = None, whole: bool = False):
    """Register a function of the mapped tables under ``name``; its columns get plain types.

    The SQL gets the common table expressions that it needs, unless it is ``whole`` already.
    """

    def add(build: Callable[[Mapped], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(build(Mapped(spark, sf_dir)))
        if oracle:
            ORACLES[name] = oracle if whole else sql(oracle)
        return build

    return add


class Gold:
    """The gold tables by name; each is only planned when it is asked for."""

    def __init__(self, m: Mapped) -> None:
        dsp, cs, cr = (lambda: workload.disputes(m)), (lambda: workload.cases(m)), (lambda: workload.claim_remittance(m))
        self.builders: dict[str, Callable[[], DataFrame]] = {
            "recovery": lambda: gold.recovery_by_payer(cr()),
            "cpt": lambda: gold.cpt_analysis(silver.claims(m.claims(), m.claim_lines()), cr(), fees(m)),
            "scorecard": lambda: gold.payer_scorecard(cr(), m.payers()),
            "summary": lambda: gold.financial_summary(cr()),
            "aging": lambda: gold.claims_aging(cr(), AS_OF),
            "pipeline": lambda: gold.case_pipeline(workload.silver_cases(m), workload.deadlines(m)),
            "deadlines": lambda: gold.deadline_compliance(workload.silver_deadlines(m)),
            "underpayment": lambda: gold.underpayment_detection(dsp()),
            "win_loss": lambda: gold.win_loss(cs(), dsp()),
            "analysts": lambda: gold.analyst_productivity(cs(), dsp()),
            "resolution": lambda: gold.time_to_resolution(cs(), dsp(), AS_OF),
            "providers": lambda: gold.provider_performance(m.providers(), cr(), dsp(), cs()),
            "months": lambda: gold.monthly_trends(cr(), dsp(), cs()),
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self.builders[name]()


def gold_tables(m: Mapped) -> Gold:
    return Gold(m)


def fees(m: Mapped) -> DataFrame:
    return merge.yearly_history(m.fee_versions(), ["payer_id", "cpt_code", "geo_region"]).withColumn("modifier", F.lit(""))


# ---- change capture and merges

query("c4_resolve_cdc", "SELECT row_pk, value, props FROM (SELECT *, row_number() OVER (PARTITION BY row_pk ORDER BY ts DESC, seq DESC) AS k FROM m_cdc) t WHERE k = 1 AND op <> 'D'")(lambda m: merge.resolve_cdc(m.cdc(), ["row_pk"]))
query("c2_watermark", "SELECT event_id, user_id, event_type, 'I' AS _cdc_operation FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")(lambda m: merge.watermark_changes(m.raw("events"), "ts", "2024-01-15 00:00:00")[0].select("event_id", "user_id", "event_type", "_cdc_operation"))
query(
    "c3_sync_state",
    "SELECT 'events' AS _source_table, count(*) FILTER (WHERE seq % 3 = 0) AS rows_last_sync, count(*) FILTER (WHERE op = 'I') AS inserts, count(*) FILTER (WHERE op = 'U') AS updates, count(*) FILTER (WHERE op = 'D') AS deletes FROM m_cdc UNION ALL SELECT 'idle', 0, 7, 8, 9",
)(lambda m: (lambda e: merge.sync_state(e.where("_cdc_seq % 3 = 0"), merge.sync_state(e.where("_cdc_seq % 3 <> 0"), m.spark.createDataFrame([("idle", 7, 8, 9, None)], "_source_table string, inserts long, updates long, deletes long, last_sync timestamp"))).drop("last_sync"))(m.cdc().withColumn("_source_table", F.lit("events"))))


@query(
    "c1_snapshot_diff",
    """SELECT op AS _cdc_operation, 'orders' AS _source_table, '{"o_orderkey":' || k || '}' AS row_pk, CASE op WHEN 'D' THEN '{"o_orderkey":' || k || '}' ELSE '{"o_orderkey":' || k || ',"o_orderstatus":"' || s || '"}' END AS payload FROM (
      SELECT coalesce(a.o_orderkey, b.o_orderkey) AS k, a.o_orderstatus AS s, CASE WHEN b.o_orderkey IS NULL THEN 'I' WHEN a.o_orderkey IS NULL THEN 'D' WHEN a.o_orderstatus <> b.o_orderstatus THEN 'U' END AS op FROM (SELECT * FROM orders WHERE o_orderkey % 10 <> 0) a FULL JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0) b ON a.o_orderkey = b.o_orderkey
    ) t WHERE op IS NOT NULL""",
)
def _snapshot(m: Mapped) -> DataFrame:
    now = m.raw("orders").select("o_orderkey", "o_orderstatus")
    old = now.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    _, state = merge.snapshot_diff(old, ["o_orderkey"], None, "orders")
    events, _ = merge.snapshot_diff(now.where("o_orderkey % 10 <> 0"), ["o_orderkey"], state, "orders")
    return events.drop("_cdc_timestamp")


@query("c1_ranged_diff", ORACLES["c1_snapshot_diff"], whole=True)
def _ranged(m: Mapped) -> DataFrame:
    """The same by digests of key ranges, over a stored state."""
    now = m.raw("orders").select("o_orderkey", "o_orderstatus")
    old = now.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    state = SnapshotState(m.spark, scratch(m.spark, "state"), buckets=32)
    state.diff(old, ["o_orderkey"], "orders")
    return state.diff(now.where("o_orderkey % 10 <> 0"), ["o_orderkey"], "orders").drop("_cdc_timestamp")


_STAGED = "SELECT payer_id, cpt_code, geo_region, CASE WHEN v % 2 = 0 THEN rate ELSE rate + 1 END AS rate FROM h_fees WHERE is_current = 1"


@query(
    "m2_scd2_merge",
    f"WITH st AS ({_STAGED}), ch AS (SELECT h.*, st.rate AS new_rate FROM h_fees h JOIN st USING (payer_id, cpt_code, geo_region) WHERE h.is_current = 1) SELECT payer_id, cpt_code, geo_region, CAST(rate AS DOUBLE) AS rate, valid_from, valid_to, CAST(is_current AS BIGINT) AS is_current, merge_action FROM (SELECT payer_id, cpt_code, geo_region, rate, valid_from, CAST(valid_to AS DATE) AS valid_to, 0 AS is_current, 'history' AS merge_action FROM h_fees WHERE is_current = 0 UNION ALL SELECT payer_id, cpt_code, geo_region, rate, valid_from, CASE WHEN rate <> new_rate THEN DATE '2009-12-31' ELSE CAST(valid_to AS DATE) END, CASE WHEN rate <> new_rate THEN 0 ELSE 1 END, CASE WHEN rate <> new_rate THEN 'closed' ELSE 'unchanged' END FROM ch UNION ALL SELECT payer_id, cpt_code, geo_region, new_rate, DATE '2010-01-01', DATE '9999-12-31', 1, 'inserted' FROM ch WHERE rate <> new_rate) t".replace(
        "WITH st AS", "WITH_ st AS"
    ),
)
def _scd2(m: Mapped) -> DataFrame:
    history = fees(m).select("payer_id", "cpt_code", "geo_region", "rate", "valid_from", "valid_to", "is_current", "v")
    staged = history.where("is_current = 1").withColumn("rate", F.when(F.col("v") % 2 == 0, F.col("rate")).otherwise(F.col("rate") + 1).cast("decimal(18,2)")).select("payer_id", "cpt_code", "geo_region", "rate", F.lit("2010-01-01").cast("date").alias("effective_date"))
    return merge.scd2_merge(history.drop("v"), staged, ["payer_id", "cpt_code", "geo_region"], ["rate"])


ORACLES["m2_scd2_merge"] = ORACLES["m2_scd2_merge"].replace(") WITH_ st AS", "), st AS")

query("m5_merge_counts", sql(f"SELECT CASE WHEN changed THEN 'updated' ELSE 'unchanged' END AS merge_action, count(*) AS n FROM (SELECT s_suppkey % 3 = 0 AS changed FROM supplier) t GROUP BY 1"))(
    lambda m: merge.merge_counts(merge.scd1_merge(m.raw("supplier").select("s_suppkey", "s_name"), m.raw("supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, "new").otherwise(F.col("s_name")).alias("s_name")), ["s_suppkey"], ["s_name"]))
)


@query(
    "k2_upsert",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'changed' ELSE s_name END AS s_name FROM supplier UNION ALL SELECT s_suppkey + 1000000, 'changed' FROM supplier WHERE s_suppkey % 4 = 0",
)
def _upsert(m: Mapped) -> DataFrame:
    old = m.raw("supplier").select("s_suppkey", "s_name")
    some = old.where("s_suppkey % 4 = 0").withColumn("s_name", F.lit("changed"))
    return merge.upsert(old, some.unionByName(some.withColumn("s_suppkey", F.col("s_suppkey") + 1_000_000)), ["s_suppkey"])


_FACTS = "SELECT l.claim_id, l.cpt_code, l.geo_region, c.date_of_service FROM (SELECT claim_id, min(cpt_code) AS cpt_code, min(geo_region) AS geo_region FROM m_lines GROUP BY claim_id) l JOIN m_claims c ON c.claim_id = l.claim_id"


@query("g2b_rate_as_of", f"SELECT f.claim_id, f.cpt_code, f.geo_region, f.date_of_service, CAST(h.rate AS DOUBLE) AS rate FROM ({_FACTS}) f LEFT JOIN h_fees h ON h.payer_id = 'MEDICARE' AND h.cpt_code = f.cpt_code AND h.geo_region = f.geo_region AND f.date_of_service BETWEEN h.valid_from AND h.valid_to")
def _as_of(m: Mapped) -> DataFrame:
    facts = m.claim_lines().groupBy("claim_id").agg(F.min("cpt_code").alias("cpt_code"), F.min("geo_region").alias("geo_region")).join(m.claims().select("claim_id", "date_of_service"), "claim_id")
    return merge.as_of_lookup(facts, fees(m).where("payer_id = 'MEDICARE'"), ["cpt_code", "geo_region"], "date_of_service", "rate")


# ---- silver

query("t3_claims", "SELECT claim_id, CAST(line_count AS BIGINT) AS line_count, array_to_string(codes, ',') AS cpt_codes, CAST(total_units AS BIGINT) AS total_units FROM scl")(
    lambda m: silver.claims(m.claims(), m.claim_lines()).select("claim_id", "line_count", F.array_join("cpt_codes", ",").alias("cpt_codes"), "total_units")
)
query("t4_remittances", "SELECT r.claim_id, r.trace_number, c.payer_id, p.name AS payer_name, CAST(r.paid_amount AS DOUBLE) AS paid_amount FROM m_remits r LEFT JOIN m_claims c ON c.claim_id = r.claim_id LEFT JOIN m_payers p ON p.payer_id = c.payer_id")(
    lambda m: silver.remittances(m.remittances(), m.payers(), m.claims()).select("claim_id", "trace_number", "payer_id", "payer_name", "paid_amount")
)
query("t5_claim_remittance", "SELECT claim_id, payer_id, payer_name, provider_npi, date_of_service, status, CAST(total_billed AS DOUBLE) AS total_billed, CAST(total_paid AS DOUBLE) AS total_paid, CAST(total_allowed AS DOUBLE) AS total_allowed, CAST(underpayment AS DOUBLE) AS underpayment, CAST(remittance_count AS BIGINT) AS remittance_count, CAST(has_denial AS BIGINT) AS has_denial FROM cr")(
    workload.claim_remittance
)
query("t6_fee_schedule", "SELECT payer_id, cpt_code, geo_region, CAST(rate AS DOUBLE) AS rate, valid_from, CAST(valid_to AS DATE) AS valid_to, CAST(is_current AS BIGINT) AS is_current, '' AS modifier FROM h_fees")(
    lambda m: silver.fee_schedule(fees(m)).select("payer_id", "cpt_code", "geo_region", "rate", "valid_from", "valid_to", "is_current", "modifier")
)
query("t7_disputes", "SELECT dispute_id, dsp.claim_id, dsp.payer_id, payer_name, dsp.provider_npi, c.date_of_service FROM dsp JOIN m_claims c ON c.claim_id = dsp.claim_id")(
    lambda m: silver.disputes(workload.disputes(m).drop("payer_id", "payer_name", "provider_npi"), m.claims(), m.payers()).select("dispute_id", "claim_id", "payer_id", "payer_name", "provider_npi", "date_of_service")
)
query("t8_cases", "SELECT case_id, status, priority, CAST(dispute_count AS BIGINT) AS dispute_count, CAST(total_billed AS DOUBLE) AS total_billed, CAST(total_underpayment AS DOUBLE) AS total_underpayment, age_days FROM scs")(
    lambda m: workload.silver_cases(m).select("case_id", "status", "priority", "dispute_count", "total_billed", "total_underpayment", "age_days")
)
query("t9_deadlines", "SELECT case_id, dispute_id, deadline_type, CAST(due_date AS DATE) AS due_date, status, days_remaining, CAST(is_at_risk AS BIGINT) AS is_at_risk FROM sdl")(workload.silver_deadlines)

# ---- gold

for _name, _key, _cte in [
    ("g1_recovery_by_payer", "recovery", "g1"),
    ("g2_cpt_analysis", "cpt", "g2"),
    ("g3_payer_scorecard", "scorecard", "g3"),
    ("g4_financial_summary", "summary", "g4"),
    ("g5_claims_aging", "aging", "g5"),
    ("g6_case_pipeline", "pipeline", "g6"),
    ("g7_deadline_compliance", "deadlines", "g7"),
    ("g8_underpayment_detection", "underpayment", "g8"),
    ("g9_win_loss", "win_loss", "g9"),
    ("g10_analyst_productivity", "analysts", "g10"),
    ("g11_time_to_resolution", "resolution", "g11"),
    ("g12_provider_performance", "providers", "g12"),
    ("g13_monthly_trends", "months", "g13"),
]:
    query(_name, f"SELECT * FROM {_cte}")(lambda m, k=_key: gold_tables(m)[k])

query("g2c_cpt_line_level", f"SELECT l.cpt_code, count(DISTINCT l.claim_id) AS claim_count, CAST(sum(l.billed_amount) AS DOUBLE) AS total_billed, {_cents('coalesce(sum(p.paid), 0)')} AS total_paid FROM m_lines l LEFT JOIN (SELECT cr.claim_id, {_share('cr.total_paid', 'n.n')} AS paid FROM cr JOIN (SELECT claim_id, count(*) AS n FROM m_lines GROUP BY claim_id) n ON n.claim_id = cr.claim_id) p ON p.claim_id = l.claim_id GROUP BY l.cpt_code")(
    lambda m: gold.cpt_line_level(m.claim_lines(), workload.claim_remittance(m))
)
query("g3b_days_to_pay", "SELECT c.payer_id, round(avg(r.era_date - c.date_of_service), 2) AS avg_days_to_pay, count(*) AS remittance_count FROM m_claims c JOIN m_remits r ON r.claim_id = c.claim_id GROUP BY c.payer_id")(lambda m: gold.days_to_pay(m.claims(), m.remittances()))

# ---- measures

_A = {
    "a1_kpis": ("summary", measures.kpis, "SELECT total_billed, total_paid, total_underpayment, recovery_rate_pct, denial_rate_pct, total_claims, avg_billed_per_claim FROM g4w"),
    "a2_risk_labels": ("scorecard", measures.status_labels, "SELECT payer_id, risk_tier, CASE risk_tier WHEN 'high' THEN 'red' WHEN 'medium' THEN 'amber' ELSE 'green' END AS risk_colour, payment_rate_pct, CASE WHEN payment_rate_pct >= 80 THEN 'good' WHEN payment_rate_pct >= 50 THEN 'fair' ELSE 'poor' END AS recovery_status FROM g3"),
    "a2_sla_labels": ("pipeline", measures.sla_labels, "SELECT status, sla_compliance_pct, CASE WHEN sla_compliance_pct >= 90 THEN 'good' WHEN sla_compliance_pct >= 70 THEN 'fair' ELSE 'poor' END AS sla_status FROM g6"),
    "a3_payer_risk": ("scorecard", measures.payer_risk, "SELECT count(DISTINCT payer_id) AS payer_count, count(*) FILTER (WHERE risk_tier = 'high') AS high_risk_count, coalesce(sum(total_underpayment) FILTER (WHERE risk_tier = 'high'), 0.0) AS revenue_at_risk FROM g3"),
    "a4_weighted_recovery": ("recovery", measures.weighted_recovery, f"SELECT {_pct('sum(total_paid)', 'sum(total_billed)')} AS weighted_recovery_pct, sum(total_billed) - sum(total_paid) AS net_underpayment FROM g1"),
    "a5_cpt_efficiency": ("cpt", measures.cpt_efficiency, f"SELECT {_pct('sum(total_paid)', 'sum(total_billed)')} AS payment_efficiency_pct, round(avg(avg_paid - medicare_rate), 2) AS avg_medicare_gap FROM g2"),
    "a6_aged_claims": ("aging", measures.aged_claims, f"SELECT {_pct('sum(claim_count) FILTER (WHERE aging_bucket IN (' + chr(39) + '91-180 days' + chr(39) + ', ' + chr(39) + '180+ days' + chr(39) + '))', 'sum(claim_count)')} AS over_90_pct, coalesce(sum(total_unpaid) FILTER (WHERE aging_bucket IN ('91-180 days', '180+ days')), 0.0) AS unpaid_aged_total FROM g5"),
    "a7_pipeline_value": ("pipeline", measures.pipeline_value, "SELECT CAST(sum(case_count) FILTER (WHERE status NOT IN ('closed', 'decided')) AS BIGINT) AS active_cases, sum(total_underpayment) FILTER (WHERE status NOT IN ('closed', 'decided')) AS pipeline_value, round(avg(sla_compliance_pct), 2) AS avg_sla_pct FROM g6"),
    "a8_compliance": ("deadlines", measures.overall_compliance, f"SELECT {_pct('sum(met_count)', 'sum(total_deadlines)')} AS compliance_pct, CAST(sum(at_risk_count) AS BIGINT) AS total_at_risk, CAST(sum(missed_count) AS BIGINT) AS total_missed FROM g7"),
    "a9_arbitration": ("underpayment", measures.arbitration, "SELECT count(*) FILTER (WHERE arbitration_eligible = 1) AS eligible_count, coalesce(sum(underpayment_amount) FILTER (WHERE arbitration_eligible = 1), 0.0) AS eligible_value, round(avg(underpayment_pct), 2) AS avg_underpayment_pct FROM g8"),
    "a10_outcomes": ("win_loss", measures.outcomes, f"SELECT {_pct('coalesce(sum(case_count) FILTER (WHERE outcome = ' + chr(39) + 'won' + chr(39) + '), 0)', 'sum(case_count)')} AS win_rate_pct, sum(total_awarded) AS total_awarded, {_pct('sum(total_awarded)', 'sum(total_disputed)')} AS roi_pct, round(sum(total_awarded) / sum(case_count), 2) AS avg_award FROM g9"),
    "a10_outcomes_by_type": ("win_loss", lambda x: measures.outcomes(x, ["dispute_type"]), f"SELECT dispute_type, {_pct('coalesce(sum(case_count) FILTER (WHERE outcome = ' + chr(39) + 'won' + chr(39) + '), 0)', 'sum(case_count)')} AS win_rate_pct, sum(total_awarded) AS total_awarded, {_pct('sum(total_awarded)', 'sum(total_disputed)')} AS roi_pct, round(sum(total_awarded) / sum(case_count), 2) AS avg_award FROM g9 GROUP BY dispute_type"),
    "a11_productivity": ("analysts", measures.productivity, f"SELECT CAST(sum(active_cases) AS BIGINT) AS active_cases, CAST(sum(resolved_cases) AS BIGINT) AS resolved_cases, round(avg(avg_resolution_days), 1) AS avg_resolution_days, {_pct('sum(won_cases)', 'sum(resolved_cases)')} AS win_rate_pct, sum(total_recovered) AS total_recovered, {_pct('sum(resolved_cases)', 'sum(total_cases)')} AS resolution_pct FROM g10"),
    "a12_resolution": ("resolution", measures.resolution, "SELECT round(avg(avg_days), 1) AS avg_resolution_days, sum(total_at_stake) AS value_at_stake FROM g11 WHERE status IN ('closed', 'decided')"),
    "a13_providers": ("providers", measures.providers, "SELECT round(avg(dispute_rate_pct), 2) AS avg_dispute_rate_pct, max(total_recovered) AS top_recovery FROM g12"),
    "a14_month_over_month": ("months", measures.month_over_month, "SELECT month, claim_count, new_disputes, resolved_cases, recovery_rate_pct, CASE WHEN lag(claim_count) OVER (ORDER BY month) > 0 THEN round((claim_count - lag(claim_count) OVER (ORDER BY month)) * 100.0 / lag(claim_count) OVER (ORDER BY month), 2) END AS growth_pct FROM g13"),
    "a15_forecast": ("underpayment", measures.forecast, "SELECT round(v * 0.60, 2) AS expected_low, round(v * 0.80, 2) AS expected_high, round(v * 0.60 * 0.85, 2) AS net_recovery FROM (SELECT sum(underpayment_amount) FILTER (WHERE arbitration_eligible = 1) AS v FROM g8) t"),
}
for _name, (_key, _f, _sql) in _A.items():
    query(_name, _sql)(lambda m, k=_key, f=_f: f(gold_tables(m)[k]))

# ---- reports

query("r1_by_underpayment", "SELECT payer_id, total_underpayment FROM g1")(lambda m: reports.by_underpayment(gold_tables(m)["recovery"]).select("payer_id", "total_underpayment"))
query("r2_scorecards", "SELECT payer_id, risk_tier, CAST(CASE risk_tier WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS BIGINT) AS severity FROM g3")(lambda m: reports.scorecards(gold_tables(m)["scorecard"]).select("payer_id", "risk_tier", "severity"))
query("r3_busiest_codes", "SELECT cpt_code, claim_count FROM g2")(lambda m: reports.busiest_codes(gold_tables(m)["cpt"]).select("cpt_code", "claim_count"))
query("r4_aging_in_order", "SELECT aging_bucket, claim_count, CAST(list_position(['0-30 days', '31-60 days', '61-90 days', '91-180 days', '180+ days'], aging_bucket) - 1 AS BIGINT) AS bucket_order FROM g5")(lambda m: reports.aging_in_order(gold_tables(m)["aging"]).select("aging_bucket", "claim_count", "bucket_order"))
query("r5_pipeline", "SELECT status, case_count FROM g6")(lambda m: reports.pipeline_in_order(gold_tables(m)["pipeline"]).select("status", "case_count"))
query("r6_top_underpayments", "SELECT dispute_id, underpayment_amount FROM g8 ORDER BY underpayment_amount DESC, dispute_id LIMIT 20")(lambda m: reports.top_underpayments(gold_tables(m)["underpayment"]).select("dispute_id", "underpayment_amount"))
query("r6_top_eligible", "SELECT dispute_id, underpayment_amount FROM g8 WHERE arbitration_eligible = 1 ORDER BY underpayment_amount DESC, dispute_id LIMIT 10")(lambda m: reports.top_underpayments(gold_tables(m)["underpayment"], 10, True).select("dispute_id", "underpayment_amount"))
query("r8_underpaid_listing", "SELECT claim_id, payer_name, CAST(total_billed AS DOUBLE) AS total_billed, CAST(total_paid AS DOUBLE) AS total_paid, CAST(underpayment AS DOUBLE) AS underpayment FROM cr WHERE underpayment > 0")(lambda m: reports.underpaid_listing(workload.claim_remittance(m)))
query("r9_denials", "SELECT claim_id, trace_number, denial_code, CAST(paid_amount AS DOUBLE) AS paid_amount FROM m_remits WHERE denial_code IS NOT NULL AND denial_code <> ''")(lambda m: reports.denials(m.remittances()))
query("r9_open_deadlines", "SELECT case_id, deadline_type, CAST(due_date AS DATE) AS due_date, CAST(due_date - DATE '2001-08-01' AS BIGINT) AS days_remaining FROM dl WHERE status = 'pending'")(lambda m: reports.open_deadlines(workload.deadlines(m), AS_OF))
query("r10_status_distribution", "SELECT status, count(*) AS n FROM m_claims GROUP BY status")(lambda m: reports.distribution(m.claims()))
query("r10_case_statuses", "SELECT status, count(*) AS n FROM cs GROUP BY status")(lambda m: reports.distribution(workload.cases(m)))
query("r10_deadline_statuses", "SELECT status, count(*) AS n FROM dl GROUP BY status")(lambda m: reports.distribution(workload.deadlines(m)))
query("r11_row_counts", "SELECT 'claims' AS table_name, count(*) AS n FROM m_claims UNION ALL SELECT 'claim_lines', count(*) FROM m_lines UNION ALL SELECT 'remittances', count(*) FROM m_remits")(lambda m: reports.row_counts({"claims": m.claims(), "claim_lines": m.claim_lines(), "remittances": m.remittances()}))
query("r12_worst_ratios", "SELECT cpt_code, payment_ratio_pct FROM g2")(lambda m: reports.worst_ratios(gold_tables(m)["cpt"]).select("cpt_code", "payment_ratio_pct"))
query("n1_recovery_opportunity", "SELECT payer_id, payer_name, arbitration_eligible, count(*) AS dispute_count, round(sum(underpayment_amount), 2) AS total_underpayment, round(sum(underpayment_amount) * 0.6, 2) AS expected_recovery FROM g8 GROUP BY ALL")(lambda m: analyses.run_analysis("recovery_opportunity", gold_tables(m)))
query("n1_denial_patterns", "SELECT count(*) AS payer_count, round(avg(denial_rate_pct), 2) AS avg_denial_rate_pct, round(corr(denial_rate_pct, total_underpayment), 6) AS denial_underpayment_corr FROM g3")(lambda m: analyses.run_analysis("denial_patterns", gold_tables(m)))
query("n1_provider_analysis", "SELECT specialty, count(*) AS provider_count, CAST(sum(total_claims) AS BIGINT) AS total_claims, CAST(sum(total_disputes) AS BIGINT) AS total_disputes, round(avg(payment_rate_pct), 2) AS avg_payment_rate_pct FROM g12 GROUP BY specialty")(lambda m: analyses.run_analysis("provider_analysis", gold_tables(m)))

_N1 = {
    "executive_summary": "SELECT * FROM g4",
    "worst_payers": "SELECT * FROM g3 ORDER BY payment_rate_pct, payer_id LIMIT 5",
    "arbitration_ready": "SELECT * FROM g8 WHERE arbitration_eligible = 1 ORDER BY underpayment_amount DESC, dispute_id LIMIT 10",
    "cpt_underpayment": "SELECT * FROM g2",
    "deadline_risk": "SELECT * FROM g7",
    "case_pipeline": "SELECT * FROM g6",
    "aging_analysis": "SELECT *, CAST(list_position(['0-30 days', '31-60 days', '61-90 days', '91-180 days', '180+ days'], aging_bucket) - 1 AS BIGINT) AS bucket_order FROM g5",
    "payer_comparison": "SELECT * FROM g3",
    "win_loss": "SELECT * FROM g9",
    "analyst_performance": "SELECT * FROM g10",
    "resolution_time": "SELECT * FROM g11",
}
for _name, _sql in _N1.items():
    query(f"n1_{_name}", _sql)(lambda m, n=_name: analyses.run_analysis(n, gold_tables(m)))
query("n1_monthly_trends", _A["a14_month_over_month"][2].replace("SELECT month", "SELECT month"))(lambda m: analyses.run_analysis("monthly_trends", gold_tables(m)).select("month", "claim_count", "new_disputes", "resolved_cases", "recovery_rate_pct", "growth_pct"))

# ---- workflow

query("w1_underpaid_claims", "SELECT claim_id, CAST(underpayment_amount AS DOUBLE) AS gap FROM dsp")(lambda m: workflow.underpaid_claims(m.claims(), m.remittances()).select("claim_id", (F.col("total_billed") - F.col("paid")).alias("gap")))
query("w2_disputes", "SELECT dispute_id, claim_id, case_id, dispute_type, CAST(qpa_amount AS DOUBLE) AS qpa_amount, CAST(filed_date AS DATE) AS filed_date, CAST(filed_date + 30 AS DATE) AS open_negotiation_deadline FROM dsp")(lambda m: workload.disputes(m).select("dispute_id", "claim_id", "case_id", "dispute_type", "qpa_amount", "filed_date", "open_negotiation_deadline"))
query("w2_cases", "SELECT case_id, assigned_analyst, priority, CAST(created_date AS DATE) AS created_date FROM cs")(lambda m: workflow.open_cases(workload.disputes(m)).select("case_id", "assigned_analyst", "priority", "created_date"))
query("w2_mark_in_dispute", "SELECT c.claim_id, CASE WHEN d.claim_id IS NULL THEN c.status ELSE 'in_dispute' END AS status FROM m_claims c LEFT JOIN dsp d ON d.claim_id = c.claim_id")(lambda m: workflow.mark_in_dispute(m.claims(), workload.disputes(m)).select("claim_id", "status"))
query("w3_deadlines", "SELECT case_id, dispute_id, deadline_type, CAST(due_date AS DATE) AS due_date FROM dl")(lambda m: workflow.make_deadlines(workload.disputes(m)).select("case_id", "dispute_id", "deadline_type", "due_date"))
query("w4_at_risk", "SELECT dl.case_id, deadline_type, assigned_analyst, CAST(due_date - DATE '2001-08-01' AS BIGINT) AS days_remaining FROM dl JOIN cs ON cs.case_id = dl.case_id WHERE dl.status = 'pending' AND due_date BETWEEN DATE '2001-08-01' AND DATE '2001-08-06'")(lambda m: workflow.at_risk(workload.deadlines(m), workload.cases(m), AS_OF).select("case_id", "deadline_type", "assigned_analyst", "days_remaining"))
query("w5_missed", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN status = 'pending' AND due_date < DATE '2001-08-01' THEN 'missed' ELSE status END AS status FROM dl) t GROUP BY status")(lambda m: reports.distribution(workflow.mark_missed(workload.deadlines(m), AS_OF)))
query("w6_alerted", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN status = 'pending' AND due_date BETWEEN DATE '2001-08-01' AND DATE '2001-08-06' THEN 'alerted' ELSE status END AS status FROM dl) t GROUP BY status")(lambda m: reports.distribution(workflow.mark_alerted(workload.deadlines(m), workflow.at_risk(workload.deadlines(m), workload.cases(m), AS_OF), AS_OF)))
query("w7_escalated", "SELECT priority, count(*) AS n FROM (SELECT CASE WHEN case_id IN (SELECT case_id FROM dl WHERE deadline_type IN ('idr_initiation', 'idr_decision', 'evidence_submission') AND (status = 'missed' OR (status = 'pending' AND due_date < DATE '2001-08-01'))) THEN 'critical' ELSE priority END AS priority FROM cs) t GROUP BY priority")(lambda m: reports.distribution(workflow.escalate(workload.cases(m), workflow.mark_missed(workload.deadlines(m), AS_OF)), "priority"))
query("w8_monitor", "SELECT count(*) FILTER (WHERE soon) AS at_risk, count(*) FILTER (WHERE late) AS missed, count(DISTINCT CASE WHEN late AND deadline_type IN ('idr_initiation', 'idr_decision') THEN case_id END) AS escalated, count(*) FILTER (WHERE soon OR late) AS alerts FROM (SELECT *, status = 'pending' AND due_date < DATE '2001-08-01' AS late, status = 'pending' AND due_date BETWEEN DATE '2001-08-01' AND DATE '2001-08-06' AS soon FROM dl) t")(lambda m: workflow.monitor(workload.deadlines(m), workload.cases(m), AS_OF))


@query(
    "w9_transitions",
    "SELECT status AS current_status, target AS target_status, (status, target) IN (('open', 'in_review'), ('in_review', 'negotiation'), ('in_review', 'closed'), ('negotiation', 'idr_initiated'), ('negotiation', 'closed'), ('idr_initiated', 'idr_submitted'), ('idr_initiated', 'closed'), ('idr_submitted', 'decided'), ('idr_submitted', 'closed'), ('decided', 'closed')) AS valid, count(*) AS n FROM (SELECT status, CASE n % 3 WHEN 0 THEN 'in_review' WHEN 1 THEN 'closed' ELSE 'idr_initiated' END AS target FROM cs) t GROUP BY ALL",
)
def _transitions(m: Mapped) -> DataFrame:
    n = F.substring("case_id", 6, 20).cast("long") % 3
    cases = workload.cases(m)
    wanted = cases.select("case_id", F.when(n == 0, "in_review").when(n == 1, "closed").otherwise("idr_initiated").alias("target_status"))
    return workflow.judge_transitions(wanted, cases).groupBy("current_status", "target_status", "valid").agg(F.count("*").alias("n"))


@query(
    "w11_windowed_alerts",
    """
    WITH e AS (SELECT date_trunc('hour', ts) AS h, date_trunc('day', ts) AS d, event_type, event_id FROM events),
    ch AS (SELECT unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM e WHERE event_type = 'purchase'), ed AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM e WHERE event_type = 'signup')
    SELECT metric, CAST(w AS TIMESTAMP) AS window_start, value, alert FROM (
      SELECT 'claims_per_hour' AS metric, ch.h AS w, CAST(count(e.h) AS DOUBLE) AS value, count(e.h) < 10 AS alert FROM ch LEFT JOIN e ON e.h = ch.h AND event_type = 'purchase' WHERE hour(ch.h) BETWEEN 8 AND 17 GROUP BY ch.h
      UNION ALL SELECT 'era_per_day', ed.d, CAST(count(e.d) AS DOUBLE), count(e.d) < 1 FROM ed LEFT JOIN e ON e.d = ed.d AND event_type = 'signup' GROUP BY ed.d
      UNION ALL SELECT 'parse_failure_pct', h, round(count(*) FILTER (WHERE event_id % 19 = 0) * 100.0 / count(*), 4), count(*) FILTER (WHERE event_id % 19 = 0) * 100.0 / count(*) > 5 FROM e WHERE event_type = 'view' GROUP BY h
      UNION ALL SELECT 'unmatched_pct', d, round(count(*) FILTER (WHERE event_id % 10 = 0) * 100.0 / count(*), 4), round(count(*) FILTER (WHERE event_id % 10 = 0) * 100.0 / count(*), 4) > 10 FROM e WHERE event_type = 'signup' GROUP BY d
      UNION ALL SELECT 'avg_confidence_pct', d, round(avg((event_id % 30 + 70) / 100.0) * 100.0, 4), round(avg((event_id % 30 + 70) / 100.0) * 100.0, 4) < 85 FROM e WHERE event_type = 'click' GROUP BY d)
    """,
    whole=True,
)
def _windowed_alerts(m: Mapped) -> DataFrame:
    """Events as claims, messages, remittances and documents that came in."""
    kind = F.when(F.col("event_type") == "purchase", "claim").when(F.col("event_type") == "view", "message").when(F.col("event_type") == "signup", "era").when(F.col("event_type") == "click", "document")
    failed = F.when(F.col("event_type") == "view", F.col("event_id") % 19 == 0).otherwise(F.col("event_id") % 10 == 0)
    rows = m.raw("events").select(F.col("ts").cast("timestamp").alias("at"), kind.alias("kind"), failed.alias("failed"), ((F.col("event_id") % 30 + 70) / 100.0).alias("confidence"))
    return workflow.windowed_alerts(rows, 8, 18).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


query("w10_deadline_status", "SELECT derived, count(*) AS n FROM (SELECT CASE WHEN status = 'met' THEN 'met' WHEN due_date < DATE '2001-08-01' THEN 'missed' WHEN due_date - DATE '2001-08-01' <= 5 THEN 'at_risk' ELSE 'pending' END AS derived FROM dl) t GROUP BY derived")(
    lambda m: workload.deadlines(m).withColumn("derived", workflow.deadline_status(F.col("due_date"), F.col("status") == "met", AS_OF)).groupBy("derived").agg(F.count("*").alias("n"))
)

# ---- design operators

_CODED = "(SELECT d.*, k.cpt_code FROM dsp d JOIN (SELECT claim_id, min(cpt_code) AS cpt_code FROM m_lines GROUP BY claim_id) k ON k.claim_id = d.claim_id)"


@query(
    "z2_recovery_potential",
    f"SELECT d.dispute_id, CAST(d.underpayment_amount AS DOUBLE) * coalesce(w.r, 0) AS potential, CASE WHEN CAST(d.underpayment_amount AS DOUBLE) * coalesce(w.r, 0) >= 100 THEN 'pursue' ELSE 'review' END AS route FROM {_CODED} d JOIN cs c ON c.case_id = d.case_id LEFT JOIN (SELECT d.payer_id, d.cpt_code, count(*) FILTER (WHERE outcome = 'won') / count(*) AS r FROM cs c JOIN {_CODED} d ON d.case_id = c.case_id WHERE c.status IN ('decided', 'closed') GROUP BY 1, 2) w ON w.payer_id = d.payer_id AND w.cpt_code = d.cpt_code WHERE c.status NOT IN ('decided', 'closed')",
)
def _potential(m: Mapped) -> DataFrame:
    code = m.claim_lines().groupBy("claim_id").agg(F.min("cpt_code").alias("cpt_code"))
    rows = workload.disputes(m).join(workload.cases(m).select("case_id", "status", "outcome"), "case_id").join(code, "claim_id")
    return design.recovery_potential(rows.where("status not in ('decided', 'closed')"), rows.where("status in ('decided', 'closed')"), ["payer_id", "cpt_code"]).select("dispute_id", "potential", "route")


query("z3_tiered_alerts", "SELECT case_id, deadline_type, CASE WHEN k < 0 THEN 'missed' WHEN k <= 3 THEN 'urgent' ELSE 'warning' END AS tier FROM (SELECT *, due_date - DATE '2001-08-01' AS k FROM dl WHERE status = 'pending') t WHERE k <= 10")(lambda m: design.tiered_alerts(workload.deadlines(m), AS_OF).select("case_id", "deadline_type", "tier"))
query("z4_business_days", "SELECT dispute_id, (SELECT CAST(d AS DATE) FROM (SELECT filed_date + CAST(i AS INT) AS d FROM range(1, 20) r(i)) s WHERE isodow(d) < 6 ORDER BY d LIMIT 1 OFFSET 3) AS due FROM dsp")(lambda m: workload.disputes(m).select("dispute_id", design.add_business_days(F.col("filed_date"), 4).alias("due")))
query("z5_recovery_cube", "SELECT CAST(grouping(y, c.payer_id, l.cpt_code, l.geo_region) AS BIGINT) AS grouping, y AS service_year, c.payer_id, l.cpt_code, l.geo_region, count(*) AS line_count, CAST(sum(l.billed_amount) AS DOUBLE) AS total_billed FROM m_lines l JOIN (SELECT *, CAST(year(date_of_service) AS BIGINT) AS y FROM m_claims) c ON c.claim_id = l.claim_id GROUP BY CUBE (y, c.payer_id, l.cpt_code, l.geo_region)")(lambda m: design.recovery_cube(m.claim_lines(), workload.claim_remittance(m)))
query("z6_award_spread", f"SELECT d.payer_id, count(*) AS award_count, {_mean('sum(c.award_amount - d.qpa_amount)', 'count(*)')} AS avg_spread, {_pct('sum(c.award_amount)', 'sum(d.qpa_amount)')} AS award_to_qpa_pct FROM dsp d JOIN cs c ON c.case_id = d.case_id WHERE c.award_amount IS NOT NULL GROUP BY d.payer_id")(lambda m: design.award_spread(workload.disputes(m), workload.cases(m)))
query("z16_median_rates", "SELECT cpt_code, geo_region, count(*) AS contract_count, median(CAST(rate AS DOUBLE)) AS qpa FROM m_fees GROUP BY cpt_code, geo_region")(lambda m: design.median_rates(m.fee_versions()))

# ---- quality

_EDGES = [
    ("claims_payers", "m_claims", "payer_id", "(SELECT payer_id FROM m_payers WHERE payer_id % 5 <> 1)", "payer_id"),
    ("claims_providers", "m_claims", "provider_npi", "(SELECT npi FROM m_providers WHERE npi % 6 <> 1)", "npi"),
    ("claims_patients", "m_claims", "patient_id", "(SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 1)", "c_custkey"),
    ("remittances_claims", "m_remits", "claim_id", "(SELECT claim_id FROM m_claims WHERE claim_id % 8 <> 1)", "claim_id"),
    ("disputes_claims", "dsp", "claim_id", "(SELECT claim_id FROM m_claims WHERE claim_id % 9 <> 1)", "claim_id"),
    ("disputes_cases", "dsp", "case_id", "(SELECT case_id FROM cs WHERE n % 4 <> 1)", "case_id"),
    ("deadlines_cases", "dl", "case_id", "(SELECT case_id FROM cs WHERE n % 3 <> 1)", "case_id"),
    ("deadlines_disputes", "dl", "dispute_id", "(SELECT dispute_id FROM dsp WHERE claim_id % 11 <> 1)", "dispute_id"),
    ("evidence_cases", "(SELECT CASE WHEN n % 2 = 0 THEN case_id END AS case_id FROM cs)", "case_id", "(SELECT case_id FROM cs WHERE n % 3 <> 1)", "case_id"),
]


@query(
    "q1_orphans",
    " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS orphan_count FROM {child} x WHERE NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{pk} = x.{ck})" + (f" AND x.{ck} IS NOT NULL" if name == "evidence_cases" else "") for name, child, ck, parent, pk in _EDGES
    ),
)
def _orphans(m: Mapped) -> DataFrame:
    """Each parent lacks some rows, so that there is something to find."""
    number = lambda df, c: df.where((F.regexp_extract(c, "[0-9]+", 0).cast("long") % 3) != 1)
    cases, dsp, dl = workload.cases(m), workload.disputes(m), workload.deadlines(m)
    n = F.regexp_extract("case_id", "[0-9]+", 0).cast("long")
    evidence = cases.select(F.when(n % 2 == 0, F.col("case_id")).alias("case_id"))
    return quality.orphans(
        [
            ("claims_payers", m.claims(), "payer_id", m.payers().where("payer_id % 5 <> 1"), "payer_id"),
            ("claims_providers", m.claims(), "provider_npi", m.providers().where("npi % 6 <> 1"), "npi"),
            ("claims_patients", m.claims(), "patient_id", m.raw("customer").where("c_custkey % 7 <> 1"), "c_custkey"),
            ("remittances_claims", m.remittances(), "claim_id", m.claims().where("claim_id % 8 <> 1"), "claim_id"),
            ("disputes_claims", dsp, "claim_id", m.claims().where("claim_id % 9 <> 1"), "claim_id"),
            ("disputes_cases", dsp, "case_id", cases.where(n % 4 != 1), "case_id"),
            ("deadlines_cases", dl, "case_id", number(cases, "case_id"), "case_id"),
            ("deadlines_disputes", dl, "dispute_id", dsp.where("claim_id % 11 <> 1"), "dispute_id"),
            ("evidence_cases", evidence, "case_id", number(cases, "case_id"), "case_id"),
        ],
        optional=("evidence_cases",),
    )


_RULES = {
    "negative_billed": ("m_claims", "total_billed < 100000"),
    "claims_invalid_status": ("m_claims", "status NOT IN ('filed', 'denied', 'underpaid')"),
    "negative_paid": ("m_remits", "paid_amount < 20000"),
    "paid_over_billed": ("dsp", "paid_amount > billed_amount * 0.4"),
    "disputes_invalid_type": ("dsp", "dispute_type NOT IN ('appeal', 'idr', 'underpayment')"),
    "decided_without_outcome": ("cs", "status = 'decided' AND outcome IS NULL"),
    "cases_invalid_status": ("cs", "status NOT IN ('open', 'in_review', 'negotiation', 'idr_initiated', 'idr_submitted', 'closed')"),
    "met_after_today": ("dl", "status = 'met' AND due_date > DATE '2001-08-01'"),
    "met_without_completed_date": ("dlc", "status = 'met' AND completed_date IS NULL"),
}


@query("q2_rules", " UNION ALL ".join(f"SELECT '{name}' AS rule_name, count(*) AS violations, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS result FROM {table} WHERE {cond}" for name, (table, cond) in _RULES.items()))
def _rules(m: Mapped) -> DataFrame:
    """The rules of each table from one pass over it; limits are such that some rows break them."""
    tables = {"m_claims": m.claims(), "m_remits": m.remittances(), "dsp": workload.disputes(m), "cs": workload.cases(m), "dl": workload.deadlines(m)}
    tables["dlc"] = tables["dl"].withColumn("completed_date", F.when((F.col("status") == "met") & (F.dayofmonth("due_date") > 3), F.col("due_date")))
    parts = [quality.rules(df, {n: F.expr(c) for n, (t, c) in _RULES.items() if t == name}) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "q2_coverage",
    "SELECT * FROM (SELECT 'claim_months' AS check_name, count(DISTINCT strftime(date_of_service, '%Y-%m')) AS n, CAST(6 AS BIGINT) AS more_than, count(DISTINCT strftime(date_of_service, '%Y-%m')) > 6 AS enough FROM m_claims UNION ALL SELECT 'claim_payers', count(DISTINCT payer_id), 4, count(DISTINCT payer_id) > 4 FROM m_claims UNION ALL SELECT 'claim_providers', count(DISTINCT provider_npi), 3, count(DISTINCT provider_npi) > 3 FROM m_claims UNION ALL SELECT 'case_outcomes', count(outcome), 5, count(outcome) > 5 FROM cs UNION ALL SELECT 'case_analysts', count(DISTINCT assigned_analyst), 2, count(DISTINCT assigned_analyst) > 2 FROM cs)",
)
def _coverage(m: Mapped) -> DataFrame:
    return quality.coverage(m.claims(), workload.cases(m))


query("q3_totals", "SELECT 'claims_billed' AS total_name, CAST(sum(total_billed) AS DOUBLE) AS v FROM cr UNION ALL SELECT 'claims_paid', CAST(sum(total_paid) AS DOUBLE) FROM cr UNION ALL SELECT 'disputes_underpayment', CAST(sum(underpayment_amount) AS DOUBLE) FROM dsp UNION ALL SELECT 'cases_awarded', CAST(sum(award_amount) AS DOUBLE) FROM cs")(lambda m: quality.totals(workload.claim_remittance(m), workload.disputes(m), workload.cases(m)))
query("q4_consistency", "SELECT 'payer_sum' AS check_name, round(total_billed, 2) AS expected, (SELECT round(sum(total_billed), 2) FROM g1) AS actual, TRUE AS agrees FROM g4w UNION ALL SELECT 'month_sum', round(total_billed, 2), (SELECT round(sum(total_billed), 2) FROM g13), TRUE FROM g4w UNION ALL SELECT 'aging_share', 100.0, (SELECT round(sum(pct_of_total), 2) FROM g5), TRUE")(
    lambda m: (lambda g: quality.consistency(g["recovery"], g["summary"], g["months"], g["aging"]))(gold_tables(m))
)
query("q6_profile", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS row_count, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 4) AS null_rate, count(DISTINCT {c}) AS approx_distinct FROM {{t}}" for c in ("claim_id", "trace_number", "era_date", "denial_code")).replace("{t}", "m_remits"))(
    lambda m: quality.profile(m.remittances().select("claim_id", "trace_number", "era_date", "denial_code"), exact=True)
)
query("q6_malformed", "SELECT count(*) FILTER (WHERE NOT regexp_matches(c_name, '^Customer#[0-9]+$')) AS malformed, count(*) AS row_count FROM customer")(lambda m: quality.malformed(m.raw("customer"), "c_name", "^Customer#[0-9]+$"))

# ---- ingest on the given tables

query("e3_dedup_remittances", "SELECT claim_id, trace_number, era_date, CAST(paid_amount AS DOUBLE) AS paid_amount FROM (SELECT *, row_number() OVER (PARTITION BY claim_id, trace_number ORDER BY era_date, paid_amount) AS k FROM (SELECT * FROM m_remits UNION ALL SELECT claim_id, trace_number, era_date + 30, paid_amount + 1, allowed_amount, denial_code FROM m_remits) u WHERE claim_id % 10 <> 0) t WHERE k = 1")(
    lambda m: (lambda r: ingest.new_by_key(r.unionByName(r.withColumns({"era_date": F.date_add("era_date", 30), "paid_amount": money(F.col("paid_amount") + 1)})), r.where("claim_id % 10 = 0"), ["claim_id", "trace_number"], "era_date", "paid_amount", tasks=m.tasks("lineitem", mapped.ROWS_PER_TASK)).select("claim_id", "trace_number", "era_date", "paid_amount"))(m.remittances())
)
query("e4_dedup_documents", "SELECT count(*) AS n FROM (SELECT DISTINCT sha256(text) FROM documents) t")(lambda m: ingest.new_by_key(m.raw("documents").withColumn("content_hash", F.sha2("text", 256)), m.raw("documents").limit(0).withColumn("content_hash", F.sha2("text", 256)), ["content_hash"], "doc_id").agg(F.count("*").alias("n")))
query("e14_search", "SELECT doc_id AS chunk_id, (CAST(contains(lower(text), 'license') AS INT) + CAST(contains(lower(text), 'apache') AS INT)) AS matches FROM documents WHERE contains(lower(text), 'license') OR contains(lower(text), 'apache') ORDER BY matches DESC, chunk_id LIMIT 10")(
    lambda m: ingest.search_chunks(m.raw("documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("chunk_text")), ["license", "apache"]).select("chunk_id", "matches")
)
_WORDS = ["license", "apache", "the of", "warranty", "copyright", "@", "tion and", "zzzqqq"]


@query("e14_indexed_search", " UNION ALL ".join(f"SELECT '{w}' AS keyword, doc_id AS chunk_id, CAST(1 AS BIGINT) AS matches FROM (SELECT doc_id FROM documents WHERE contains(lower(text), '{w}') ORDER BY doc_id LIMIT 10)" for w in _WORDS))
def _indexed(m: Mapped) -> DataFrame:
    """Eight keywords by the index of trigrams, which two batches have filled."""
    index = ChunkIndex(m.spark, scratch(m.spark, "index"))
    chunks = m.raw("documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("chunk_text"))
    index.add(chunks.where("chunk_id % 3 = 0"))
    index.add(chunks.where("chunk_id % 3 <> 0"))
    return reduce(DataFrame.unionByName, [index.search([w]).select(F.lit(w).alias("keyword"), "chunk_id", "matches") for w in _WORDS])


@query(
    "q6_frequent_values",
    " UNION ALL ".join(f"SELECT * FROM (SELECT '{c}' AS column_name, day, CAST({c} AS VARCHAR) AS value, count(*) AS value_count, any_value(n) AS n FROM (SELECT *, date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS day, count(*) OVER (PARTITION BY date_trunc('month', CAST(o_orderdate AS DATE))) AS n FROM orders) GROUP BY day, {c}) WHERE value_count >= 0.05 * n" for c in ("o_orderstatus", "o_orderpriority", "o_custkey")),
)
def _frequent(m: Mapped) -> DataFrame:
    return quality.frequent_values(m.raw("orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"], F.trunc(F.col("o_orderdate").cast("date"), "month"))


@query(
    "z11_distribution_drift",
    "SELECT 'price' AS column_name, m AS month, count(*) AS n, m > 1 AND m % 2 = 1 AS drifts FROM (SELECT CAST(month(o_orderdate) AS BIGINT) AS m FROM orders) GROUP BY m",
)
def _drift(m: Mapped) -> DataFrame:
    """Amounts that double in every other pair of months: the sketches of neighbouring months tell."""
    month = F.month("o_orderdate")
    rows = m.raw("orders").select(month.alias("m"), (F.col("o_totalprice") * F.when(month % 4 >= 3, 2).when(month % 4 == 0, 2).otherwise(1)).alias("price"))
    return quality.distribution_drift(quality.day_sketches(rows, ["price"], F.col("m")), 0.2).select("column_name", F.col("day").alias("month"), "n", "drifts")


query("p10_classify", "SELECT document_type, count(*) AS n FROM (SELECT CASE WHEN contains(lower(url), 'eob') THEN 'EOB' WHEN contains(lower(url), 'clinical') OR contains(lower(url), 'medical') THEN 'clinical_record' WHEN contains(lower(url), 'contract') THEN 'contract' WHEN contains(lower(url), 'denial') OR contains(lower(url), 'correspondence') THEN 'payer_correspondence' WHEN contains(lower(url), 'appeal') THEN 'appeal' WHEN contains(lower(url), 'decision') OR contains(lower(url), 'award') THEN 'arbitration_decision' WHEN contains(lower(url), 'auth') THEN 'prior_auth' ELSE 'provider_correspondence' END AS document_type FROM pages) t GROUP BY document_type")(
    lambda m: parsers.classify(m.raw("pages"), "url").groupBy("document_type").agg(F.count("*").alias("n"))
)
query(
    "p9_chunks",
    r"""
    SELECT file, section_title, section_index, substr(sha256(file || ':' || section_title || ':' || section_index), 1, 16) AS chunk_id FROM (
      SELECT *, CASE WHEN max(header) OVER (PARTITION BY file) IS NULL THEN 'Full Document' WHEN header IS NULL THEN 'Preamble' ELSE header END AS section_title, CAST(section - min(section) OVER (PARTITION BY file) AS BIGINT) AS section_index
      FROM (
        SELECT file, section, max(CASE WHEN is_header THEN trim(line) END) AS header, regexp_replace(string_agg(line, chr(10) ORDER BY pos), '^\s+|\s+$', '', 'g') AS body FROM (
          SELECT *, sum(CAST(is_header AS INT)) OVER (PARTITION BY file ORDER BY pos) AS section FROM (
            SELECT file, pos, line, regexp_matches(trim(line), '^(Section|§|PART|SUBPART|Article)\s+[\d.]+[A-Za-z]*\.?\s*.*$') AS is_header FROM (
              SELECT CAST(doc_id AS VARCHAR) AS file, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(replace(text, '. ', chr(10) || 'Section 1. '), chr(10)) AS l FROM documents WHERE text IS NOT NULL) d
            ) a
          ) b
        ) c GROUP BY file, section
      ) e
    ) f WHERE body <> ''
    """,
)(
    lambda m: parsers.chunks(m.raw("documents").where("text is not null").select(F.col("doc_id").cast("string").alias("file"), F.replace("text", F.lit(". "), F.lit("\nSection 1. ")).alias("content"), F.col("doc_id").cast("string").alias("cfr_citation"))).select(
        "file", "section_title", "section_index", "chunk_id"
    )
)
