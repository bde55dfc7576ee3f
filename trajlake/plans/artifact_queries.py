"""Queries over artifacts of runs: observed calls against traces, completeness of artifacts and strict reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import typed as Y
from trajlake.operators import artifacts as V
from trajlake.plans.registry import query
from trajlake.plans.strict_queries import _sql

CONTRACT = V.Contract("m1", ("m1-b",), 0.5, 40, 400)

#: Observed calls: a call per order line, with faults here and there; ``{s}`` is the text type, ``{h}`` a SHA-256 expression.
CALLS = """SELECT CAST(l_orderkey AS {s}) AS job_id, nth AS position, nth - 1 + CASE WHEN l_partkey % 43 = 0 THEN 1 ELSE 0 END AS call_index,
 CASE WHEN l_partkey % 31 = 0 THEN 'failed' ELSE 'completed' END AS status, CASE WHEN l_partkey % 37 = 0 THEN 'm2' ELSE 'm1' END AS model, CASE WHEN l_suppkey % 3 = 0 THEN 'm1-b' WHEN l_suppkey % 11 = 1 THEN 'm3' ELSE 'm1' END AS response_model,
 CASE WHEN l_partkey % 29 = 0 THEN ' ' ELSE 'r' || CAST(l_orderkey AS {s}) || '-' || CAST(nth - CASE WHEN l_partkey % 23 = 0 AND nth > 1 THEN 1 ELSE 0 END AS {s}) END AS response_id,
 CASE WHEN l_partkey % 41 = 0 THEN 'text' ELSE 'chat.completion' END AS response_object, CASE WHEN l_suppkey % 3 = 0 THEN 'm1-b' WHEN l_suppkey % 13 = 1 THEN 'm1' WHEN l_suppkey % 11 = 1 THEN 'm3' ELSE 'm1' END AS identity_model,
 CAST(l_quantity + CASE WHEN l_partkey % 19 = 0 THEN 1 ELSE 0 END AS BIGINT) AS input_tokens, CAST(nth * 5 AS BIGINT) AS output_tokens, CAST(l_quantity + nth * 5 + CASE WHEN l_partkey % 19 = 0 THEN 1 ELSE 0 END AS BIGINT) AS total_tokens,
 CASE WHEN l_partkey % 53 = 0 THEN 'x' ELSE {h} END AS prompt_hash, CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE 't' END AS started_at, CAST(l_partkey % 7 - 1 AS INTEGER) AS message_count, CAST(l_suppkey % 5 AS INTEGER) AS tool_count,
 CASE WHEN l_partkey % 47 = 0 THEN 1.0E0 ELSE 5.0E-1 END AS temperature, CAST(CASE WHEN l_partkey % 61 = 0 THEN 0 ELSE 45 END AS BIGINT) AS prompt_token_upper_bound,
 CAST(least(40, 400 - 45 - (nth - 1) * 40) AS BIGINT) AS max_tokens, CAST(l_partkey % 17 - 1 AS INTEGER) AS retry_count, CAST(CASE WHEN l_partkey % 67 = 0 THEN -1 ELSE 3 END AS DOUBLE) AS latency_ms FROM {l} WHERE l_suppkey % 50 <> 7"""
RESPONSES = """SELECT CAST(l_orderkey AS {s}) AS job_id, nth * 10 AS sequence, CASE WHEN l_suppkey % 3 = 0 THEN 'm1-b' WHEN l_suppkey % 11 = 1 THEN 'm3' ELSE 'm1' END AS trace_model,
 CAST(l_quantity AS BIGINT) AS trace_input, CAST(nth * 5 AS BIGINT) AS trace_output, CAST(l_quantity + nth * 5 AS BIGINT) AS trace_total FROM {l} WHERE l_suppkey % 60 <> 11"""
_LINES = "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS nth FROM lineitem) l"
_DUCK = {"l": _LINES, "s": "VARCHAR", "h": "sha256(CAST(l_partkey AS VARCHAR))"}
_SPARK = {"l": _LINES, "s": "STRING", "h": "sha2(CAST(l_partkey AS STRING), 256)"}


@query(
    f"""WITH c AS ({CALLS.format(**_DUCK)}), r AS ({RESPONSES.format(**_DUCK)}),
 cn AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY position) AS n FROM c), rn AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY sequence) AS n FROM r),
 b AS (SELECT coalesce(cn.job_id, rn.job_id) AS j, coalesce(cn.n, rn.n) AS k, cn.* EXCLUDE (job_id, n), rn.* EXCLUDE (job_id, n), cn.n IS NULL AS no_call, rn.n IS NULL AS no_response FROM cn FULL JOIN rn ON cn.job_id = rn.job_id AND cn.n = rn.n),
 s AS (SELECT *, coalesce(sum(trace_total) OVER (PARTITION BY j ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent, CASE WHEN response_id IS NOT NULL THEN row_number() OVER (PARTITION BY j, response_id ORDER BY k) END AS again FROM b),
 l AS (SELECT *, 400 - spent - prompt_token_upper_bound AS room, least(40, 400 - spent - prompt_token_upper_bound) AS allowed FROM s)
 SELECT j AS job_id, CAST(k - 1 AS BIGINT) AS place, unnest(CASE WHEN no_response THEN ['call_without_response'] WHEN no_call THEN ['response_without_call'] ELSE list_filter([CASE WHEN call_index <> k - 1 THEN 'call_index' END, CASE WHEN status <> 'completed' THEN 'status' END, CASE WHEN model <> 'm1' THEN 'request_model' END,
 CASE WHEN response_model NOT IN ('m1', 'm1-b') THEN 'response_model' END, CASE WHEN response_model IS DISTINCT FROM trace_model THEN 'trace_model' END, CASE WHEN trim(response_id) = '' THEN 'response_id' END, CASE WHEN again > 1 THEN 'repeated_response_id' END,
 CASE WHEN response_object <> 'chat.completion' THEN 'response_object' END, CASE WHEN identity_model <> response_model THEN 'identity_model' END, CASE WHEN input_tokens IS DISTINCT FROM trace_input OR output_tokens IS DISTINCT FROM trace_output OR total_tokens IS DISTINCT FROM trace_total THEN 'usage' END,
 CASE WHEN NOT regexp_full_match(prompt_hash, '[0-9a-f]{{64}}') THEN 'prompt_hash' END, CASE WHEN started_at IS NULL THEN 'started_at' END, CASE WHEN message_count < 0 THEN 'message_count' END, CASE WHEN tool_count < 0 THEN 'tool_count' END, CASE WHEN temperature <> 0.5 THEN 'temperature' END,
 CASE WHEN prompt_token_upper_bound <= 0 THEN 'prompt_token_upper_bound' END, CASE WHEN room <= 0 THEN 'call_beyond_budget' WHEN max_tokens <> allowed THEN 'max_tokens' END, CASE WHEN trace_input > prompt_token_upper_bound THEN 'input_beyond_bound' END,
 CASE WHEN room > 0 AND trace_output > allowed THEN 'output_beyond_max_tokens' END, CASE WHEN spent + trace_total > 400 THEN 'job_beyond_budget' END, CASE WHEN retry_count < 0 THEN 'retry_count' END, CASE WHEN latency_ms < 0 THEN 'latency_ms' END], lambda x: x IS NOT NULL) END) AS code FROM l"""
)
def call_violations(spark, sf):
    return V.call_violations(_sql(spark, sf, ["lineitem"], CALLS.format(**_SPARK)), _sql(spark, sf, ["lineitem"], RESPONSES.format(**_SPARK)), CONTRACT)


#: The five sides of a run's artifacts, some of them missing, doubled, blank or foreign.
SIDES = {
    "assignment": "SELECT CAST(o_orderkey AS {s}) AS job_id FROM orders WHERE o_orderkey % 19 <> 5",
    "row": "SELECT CASE WHEN o_orderkey % 97 = 3 THEN ' ' ELSE CAST(o_orderkey AS {s}) END AS job_id, CASE o_orderstatus WHEN 'O' THEN 'pending' ELSE 'completed' END AS status, 't' || CAST(o_orderkey AS {s}) AS trace_id FROM orders WHERE o_orderkey % 23 <> 5"
    " UNION ALL SELECT CAST(o_orderkey AS {s}), 'completed', 't' || CAST(o_orderkey AS {s}) FROM orders WHERE o_orderkey % 71 = 6",
    "trace": "SELECT CAST(o_orderkey AS {s}) AS job_id, CASE WHEN o_orderkey % 37 = 4 THEN 'other' ELSE 't' || CAST(o_orderkey AS {s}) END AS trace_id FROM orders WHERE o_orderkey % 29 <> 5 AND (o_orderstatus <> 'O' OR o_orderkey % 41 = 0)",
    "report": "SELECT CAST(o_orderkey AS {s}) AS job_id, CASE WHEN o_orderkey % 43 = 4 THEN NULL ELSE 't' || CAST(o_orderkey AS {s}) END AS trace_id FROM orders WHERE o_orderkey % 31 <> 5 AND o_orderstatus <> 'O'",
    "evidence": "SELECT CAST(o_orderkey + CASE WHEN o_orderkey % 53 = 4 THEN 100000000 ELSE 0 END AS {s}) AS job_id FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey % 59 <> 5",
}
_n = {k: f"count(*) FILTER (side = '{k}') AS n_{k}" for k in SIDES}
_stack = " UNION ALL ".join(f"SELECT trim(coalesce(job_id, '')) AS job_id, '{k}' AS side, {'trace_id' if k in ('row', 'trace', 'report') else 'NULL'} AS trace_id, {'status' if k == 'row' else 'NULL'} AS status FROM ({v.format(s='VARCHAR')}) q" for k, v in SIDES.items())
_codes = (
    [f"CASE WHEN job_id = '' AND n_{k} > 0 THEN 'blank_{k}' END" for k in SIDES]
    + [f"CASE WHEN job_id <> '' AND n_{k} > 1 THEN 'double_{k}' END" for k in SIDES]
    + [f"CASE WHEN job_id <> '' AND n_assignment = 0 AND n_{k} > 0 THEN '{k}_outside_contract' END" for k in list(SIDES)[1:]]
    + ["CASE WHEN n_assignment > 0 AND n_row = 0 THEN 'missing_row' END", "CASE WHEN n_assignment > 0 AND n_row > 0 AND status <> 'completed' THEN 'not_completed' END"]
    + [f"CASE WHEN n_assignment > 0 AND n_row > 0 AND status = 'completed' AND n_{k} = 0 THEN 'missing_{k}' END" for k in list(SIDES)[2:]]
    + [f"CASE WHEN n_assignment > 0 AND (n_row = 0 OR status <> 'completed') AND n_{k} > 0 THEN '{k}_without_completed_row' END" for k in list(SIDES)[2:]]
    + [f"CASE WHEN n_{k} > 0 AND n_trace > 0 AND {k}_trace IS DISTINCT FROM trace_trace THEN 'trace_id_of_{k}' END" for k in ("row", "report")]
)
SETS = f"""st AS ({_stack}), g AS (SELECT job_id, {', '.join(_n.values())}, min(status) FILTER (side = 'row') AS status, min(trace_id) FILTER (side = 'row') AS row_trace, min(trace_id) FILTER (side = 'trace') AS trace_trace, min(trace_id) FILTER (side = 'report') AS report_trace FROM st GROUP BY 1),
 v_sets AS (SELECT *, list_filter([{', '.join(_codes)}], lambda x: x IS NOT NULL) AS codes FROM g)"""


def _sets(spark, sf):
    return V.artifact_sets(*[_sql(spark, sf, ["orders"], v.format(s="STRING")) for v in SIDES.values()])


@query(f"WITH {SETS} SELECT job_id, n_row, n_trace, n_report, n_evidence, status, len(codes) AS issues, n_assignment > 0 AND len(codes) = 0 AS complete FROM v_sets")
def artifact_sets(spark, sf):
    return _sets(spark, sf).select("job_id", "n_row", "n_trace", "n_report", "n_evidence", "status", F.size("codes").cast("long").alias("issues"), "complete")


@query(f"WITH {SETS} SELECT job_id, unnest(codes) AS code FROM v_sets")
def artifact_issues(spark, sf):
    return V.artifact_issues(_sets(spark, sf))


@query("SELECT 'r' || CAST(l_partkey AS VARCHAR) AS response_id, count(*) AS n, count(DISTINCT l_orderkey) AS jobs FROM lineitem WHERE l_partkey % 5 <> 0 GROUP BY 1 HAVING count(*) > 1")
def shared_response_ids(spark, sf):
    return V.shared_response_ids(_sql(spark, sf, ["lineitem"], "SELECT l_orderkey AS job_id, CASE WHEN l_partkey % 5 = 0 THEN ' ' ELSE 'r' || CAST(l_partkey AS STRING) END AS response_id FROM lineitem"))


#: Evaluation reports of orders as JSON, most of them with one fault by the order's number; the fault is what the checker must name.
_FAULTS = [
    ("'true'", "'\"1\"'", "0.5", "''", "''"), ("'1'", "'1'", "0.5", "''", "''"), ("'true'", "'true'", "0.5", "''", "''"), ("'true'", "'1.0'", "0.5", "''", "''"), ("'true'", "'1'", "\"0.5\"", "''", "''"),
    ("'true'", "'1'", "1e999", "''", "''"), ("'true'", "'1'", "0.5", "',\"metrics\":{\"b\":1,\"a\":true}'", "''"), ("'true'", "'1'", "0.5", "',\"turn_rewards\":[{\"turn_index\":-1}]'", "''"),
    ("'true'", "'1'", "0.5", "''", "'['"), ("'true'", "'12345678901234567890123'", "7", "',\"metrics\":{\"x\":2.5},\"more\":[null]'", "''"), ("'true'", "'-3'", "0.5", "',\"metrics\":null'", "''"), ("'true'", "'1'", "0.5", "''", "'}'"),
]
_NAMED = ["$.reward:whole", "$.success:boolean", "$.reward:whole", "$.reward:whole", "$.results[1].score:number", "$.results[1].score:number", "$.metrics.a:number", "$.turn_rewards[0].turn_index:at_least_0", "$:json", "", "$.metrics:object", "$:json"]


def _case(k: int, values: list[str]) -> str:
    return f"CASE CAST(o_orderkey % {k} AS INTEGER) " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_SCORES = _case(12, ["'" + f[2] + "'" for f in _FAULTS])
REPORTS = f"""SELECT o_orderkey, {_case(12, [f[4] for f in _FAULTS])} || '{{"scenario_instance_id":"i","infrastructure_failure":false,"success":' || {_case(12, [f[0] for f in _FAULTS])} || ',"reward":' || {_case(12, [f[1] for f in _FAULTS])}
 || ',"results":[{{"evaluator":"e","passed":true,"score":1,"reason":""}},{{"evaluator":"e","passed":true,"reason":"","score":' || {_SCORES} || '}}]' || {_case(12, [f[3] for f in _FAULTS])} || '}}' AS raw FROM orders"""


@query(f"SELECT o_orderkey, {_case(12, [repr(n) for n in _NAMED])} AS fault FROM orders")
def report_faults(spark, sf):
    return _sql(spark, sf, ["orders"], REPORTS).select("o_orderkey", Y.first_fault(F.col("raw"), Y.REPORT).alias("fault"))
