"""Queries over a finished run: its report, findings, counts and the gates of its release."""

from __future__ import annotations

from trajlake.operators import release as R
from trajlake.plans.registry import query
from trajlake.plans.strict_queries import _sql

SCENARIO = "'s' || CAST(CAST(floor(o_orderkey / 2.0) AS BIGINT) AS {s})"
T = {
    "contracted": "SELECT CAST(o_orderkey AS {s}) AS job_id FROM orders WHERE o_orderkey % 23 <> 7",
    "jobs": "SELECT CAST(o_orderkey AS {s}) AS job_id, CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderkey % 11 = 2 THEN 'infrastructure_failed' ELSE 'failed' END AS status FROM orders",
    "runs": "SELECT CAST(o_orderkey AS {s}) AS job_id, 't' || CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE o_orderkey END AS {s}) AS trace_id, " + SCENARIO + " AS scenario_id, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'timeout' ELSE 'success' END AS termination_reason,"
    " CAST(o_custkey % 3 AS INTEGER) - 1 AS reward, o_custkey % 3 = 2 AS success, o_orderkey % 31 = 0 AS infrastructure_failure, CAST(o_totalprice AS BIGINT) AS tokens, CAST(o_custkey AS DOUBLE) AS elapsed_ms, 'h' || CAST(o_orderkey % 5000 AS {s}) AS semantic_hash FROM orders WHERE o_orderstatus = 'F'",
    "leaks": "SELECT 't' || CAST(l_orderkey AS {s}) AS trace_id FROM lineitem WHERE l_partkey % 97 = 1",
    "bypasses": "SELECT 't' || CAST(l_orderkey AS {s}) AS trace_id FROM lineitem WHERE l_partkey % 89 = 1",
    "reproductions": "SELECT 't' || CAST(o_orderkey AS {s}) AS trace_id, CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE o_orderkey % 59 <> 0 END AS reproduced FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 3 = 2 AND o_orderkey % 53 <> 0",
    "tools": "SELECT 't' || CAST(l_orderkey AS {s}) AS trace_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'tool' || CAST(l_linenumber AS {s}) END AS tool FROM lineitem",
    "ledger": "SELECT CAST(l_orderkey AS {s}) AS job_id, CAST(l_quantity AS BIGINT) AS tokens, CAST(l_discount AS DECIMAL(28,10)) AS cost, CAST(l_extendedprice AS DECIMAL(28,6)) AS elapsed_ms FROM lineitem",
    "ledger_issues": "SELECT l_orderkey AS job_id FROM lineitem WHERE l_quantity < 0",
    "reproduction": "SELECT count(*) > 0 AS independent, true AS artifacts_valid, true AS semantic_match, true AS hash_match, count(*) AS required, count(*) AS reproductions, count(*) AS reproduced, count(*) AS executed FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 3 = 2",
    "exports": "SELECT CASE CAST(n_nationkey AS INTEGER) WHEN 0 THEN 'analysis' WHEN 1 THEN 'rl' WHEN 2 THEN 'sft' ELSE 'preference' END AS name, CAST(10 * n_nationkey AS BIGINT) AS records, n_nationkey <> 1 AS gate FROM nation WHERE n_nationkey < 4",
    "export_quarantine": "SELECT 't' || CAST(o_orderkey AS {s}) AS trace_id FROM orders WHERE o_orderkey % 71 = 0",
    "reviews": "SELECT count(*) > 0 AS passed FROM region",
    "review_quarantine": "SELECT 't' || CAST(o_orderkey AS {s}) AS trace_id FROM orders WHERE o_orderkey % 71 = 0 OR o_orderkey = 3",
}
TARGETS = R.Targets(trajectories=40, successes=10, sft=15, rl=10, preference=1, run_tokens=400_000, run_seconds=1.0, total_tokens=10_000_000_000, total_cost="5", total_seconds=1e9)
_tables = ["orders", "lineitem", "nation", "region"]
_views = ", ".join(f"{k} AS ({v.format(s='VARCHAR')})" for k, v in T.items())
JUDGED = f"""{_views}, again AS (SELECT trace_id, bool_and(coalesce(reproduced, false)) AS ok FROM reproductions GROUP BY 1),
 v_judged AS (SELECT r.* REPLACE (coalesce(termination_reason, 'missing') AS termination_reason), trace_id IN (SELECT trace_id FROM leaks) AS leak, trace_id IN (SELECT trace_id FROM bypasses) AS bypass, coalesce(ok, false) AS reproduced, success AND NOT coalesce(ok, false) AS unreproduced, tokens > 400000 AS over_tokens, elapsed_ms > 1000 AS over_time FROM runs r LEFT JOIN again USING (trace_id)),
 failed AS (SELECT DISTINCT job_id FROM jobs WHERE status = 'infrastructure_failed' AND job_id IN (SELECT job_id FROM contracted))"""


def _of(spark, sf, *names):
    return [_sql(spark, sf, _tables, T[n].format(s="STRING")) for n in names]


def _judged(spark, sf):
    return R.judged_runs(*_of(spark, sf, "runs", "leaks", "bypasses", "reproductions"), TARGETS)


def _report(spark, sf):
    names = ("contracted", "jobs", "ledger", "ledger_issues", "reproductions", "reproduction", "exports", "export_quarantine", "reviews", "review_quarantine")
    return R.report(_judged(spark, sf), *_of(spark, sf, *names))


@query(f"WITH {JUDGED} SELECT job_id, trace_id, termination_reason, leak, bypass, reproduced, unreproduced, over_tokens, over_time FROM v_judged")
def release_runs(spark, sf):
    return _judged(spark, sf).select("job_id", "trace_id", "termination_reason", "leak", "bypass", "reproduced", "unreproduced", "over_tokens", "over_time")


@query(f"WITH {JUDGED} SELECT DISTINCT f AS finding, trace_id AS id FROM (SELECT trace_id, unnest(list_filter([CASE WHEN leak THEN 'leak' END, CASE WHEN bypass THEN 'hard_bypass' END, CASE WHEN unreproduced THEN 'unreproduced_success' END, CASE WHEN over_tokens THEN 'agent_token_budget' END, CASE WHEN over_time THEN 'agent_time_budget' END], lambda x: x IS NOT NULL)) AS f FROM v_judged) UNION ALL SELECT 'infrastructure', job_id FROM failed")
def release_findings(spark, sf):
    return R.finding_ids(_judged(spark, sf), *_of(spark, sf, "contracted", "jobs"))


@query(f"WITH {JUDGED} SELECT 'termination' AS dimension, termination_reason AS label, count(*) AS n FROM v_judged GROUP BY 2 UNION ALL SELECT 'reward', CAST(reward AS VARCHAR), count(*) FROM v_judged GROUP BY 2 UNION ALL SELECT 'tool', coalesce(tool, 'unknown'), count(*) FROM tools WHERE trace_id IN (SELECT trace_id FROM v_judged) GROUP BY 2")
def release_counts(spark, sf):
    return R.count_maps(_judged(spark, sf), *_of(spark, sf, "tools"))


MARGINS = "v_margins AS (SELECT scenario_id FROM v_judged GROUP BY 1 HAVING count(*) = 2 AND count(*) FILTER (NOT infrastructure_failure AND trace_id NOT IN (SELECT trace_id FROM export_quarantine)) = 2 AND min(reward) <> max(reward))"


@query(f"WITH {JUDGED}, {MARGINS} SELECT scenario_id FROM v_margins")
def margin_scenarios(spark, sf):
    return R.margin_scenarios(_judged(spark, sf), *_of(spark, sf, "export_quarantine"))


REPORT = f"""{JUDGED}, {MARGINS}, v_report AS (SELECT (SELECT count(*) FROM v_judged) AS canonical, (SELECT count(*) FROM v_judged WHERE success) AS successes, (SELECT count(*) FROM v_judged WHERE leak) AS leaks, (SELECT count(*) FROM v_judged WHERE bypass) AS bypasses, (SELECT count(*) FROM v_judged WHERE unreproduced) AS unreproduced,
 (SELECT count(*) FROM v_judged WHERE over_tokens) AS over_tokens, (SELECT count(*) FROM v_judged WHERE over_time) AS over_time, (SELECT count(trace_id) - count(DISTINCT trace_id) FROM v_judged) AS duplicate_traces, (SELECT count(semantic_hash) - count(DISTINCT semantic_hash) FROM v_judged) AS semantic_duplicates, (SELECT count(*) FROM contracted) AS expected,
 (SELECT count(*) FROM failed) AS infrastructure, (SELECT CAST(sum(tokens) AS BIGINT) FROM ledger) AS total_tokens, (SELECT sum(cost) FROM ledger) AS total_cost, (SELECT CAST(sum(elapsed_ms) / 1000 AS DECIMAL(28,6)) FROM ledger) AS total_seconds, (SELECT count(*) FROM ledger_issues) AS ledger_issues,
 (SELECT count(*) FROM again) AS r_traces, (SELECT count(*) FROM again WHERE NOT ok) AS r_failed, (SELECT count(*) FROM v_margins) AS eligible, (SELECT count(*) FROM (SELECT DISTINCT trace_id FROM review_quarantine EXCEPT SELECT trace_id FROM export_quarantine)) AS quarantine_differs)"""


@query(f"WITH {REPORT} SELECT * EXCLUDE (total_cost, total_seconds), CAST(total_cost AS DOUBLE) AS total_cost, CAST(total_seconds AS DOUBLE) AS total_seconds, infrastructure / expected AS infrastructure_rate, successes / canonical AS success_rate FROM v_report")
def release_report(spark, sf):
    row = _report(spark, sf)
    row = row.withColumn("total_cost", row["total_cost"].cast("double")).withColumn("total_seconds", row["total_seconds"].cast("double"))
    return row.select(
        "canonical", "successes", "leaks", "bypasses", "unreproduced", "over_tokens", "over_time", "duplicate_traces", "semantic_duplicates", "expected", "infrastructure", "total_tokens", "total_cost", "total_seconds", "ledger_issues",
        "r_traces", "r_failed", "eligible", "quarantine_differs", "infrastructure_rate", "success_rate",
    )


_checks = [
    "canonical = expected AND expected = 40", "canonical = expected", "infrastructure / expected <= 0.05", "leaks = 0", "bypasses = 0", "(SELECT independent FROM reproduction)", "r_traces = successes AND r_failed = 0 AND unreproduced = 0", "(SELECT required FROM reproduction) = successes",
    "successes >= 10", "over_tokens = 0", "over_time = 0", "total_tokens <= 10000000000", "total_cost <= 5", "total_seconds <= 1000000000", "ledger_issues = 0", "true", "20 >= 15", "10 >= 10", "30 >= 1", "eligible = 30", "true", "true", "true", "quarantine_differs = 0",
]


@query(f"WITH {REPORT} " + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS position, '{g}' AS gate, {c} AS passed FROM v_report" for k, (g, c) in enumerate(zip(R.GATES, _checks, strict=True))))
def release_gates(spark, sf):
    return R.gates(_report(spark, sf), TARGETS)
