"""Queries over traces, conversations and reviews."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from trajlake.operators import interactions as I
from trajlake.operators import review as V
from trajlake.operators import traces as T
from trajlake.plans import adapters as A
from trajlake.plans.registry import query

W = f"WITH {A.TRACE} "
REWARDS = """v_asked AS (SELECT *, greatest(coalesce(sum(CASE WHEN event_type = 'model_response' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY sequence ROWS UNBOUNDED PRECEDING), 0) - 1, 0) AS turn,
 last_value(CASE WHEN event_type = 'tool_requested' THEN tool END IGNORE NULLS) OVER (PARTITION BY session_id, call_id ORDER BY sequence ROWS UNBOUNDED PRECEDING) AS asked FROM v_trace),
 v_rewards AS (SELECT * FROM (SELECT session_id, sequence, event_id, CAST(turn AS INTEGER) AS turn_index, CASE event_type WHEN 'tool_requested' THEN 'information_gathering' WHEN 'policy_decision' THEN 'policy' ELSE 'tool_execution' END AS kind,
 CASE WHEN event_type = 'tool_requested' THEN 'ask_user' ELSE coalesce(asked, 'tool_call') END AS action_type,
 CASE WHEN event_type = 'tool_requested' AND tool = 'ask_user' THEN 0.2::DOUBLE WHEN event_type = 'policy_decision' AND decision <> 'allow' THEN -1.0::DOUBLE WHEN event_type = 'tool_finished' AND tool_status = 'completed' THEN 0.1::DOUBLE WHEN event_type = 'tool_finished' THEN -0.1::DOUBLE END AS reward FROM v_asked) WHERE reward IS NOT NULL)"""


def _trace(spark, sf):
    return A.trace(spark, sf)


@query(f"{W}, {REWARDS} SELECT * FROM v_rewards")
def turn_rewards(spark, sf):
    return T.turn_rewards(_trace(spark, sf))


@query(f"{W}, {REWARDS} SELECT session_id, round(sum(reward), 6) AS turn_reward_total, round(avg(reward), 6) AS turn_reward_mean, count(*) FILTER (reward > 0) AS positive_turn_rewards, count(*) FILTER (reward < 0) AS negative_turn_rewards FROM v_rewards GROUP BY session_id")
def turn_reward_metrics(spark, sf):
    return T.reward_metrics(T.turn_rewards(_trace(spark, sf)))


@query(f"{W}, {REWARDS} SELECT event_id, turn_index, CASE WHEN kind IN ('information_gathering', 'policy') THEN kind ELSE 'other' END AS kind, CASE WHEN reward > 0 THEN 'positive' WHEN reward < 0 THEN 'negative' ELSE 'neutral' END AS reason, sha256(action_type) AS action_sha256, reward FROM v_rewards")
def public_turn_rewards(spark, sf):
    return T.public_rewards(T.turn_rewards(_trace(spark, sf)))


@query(W + """, c AS (SELECT *, coalesce(sum(CASE WHEN event_type = 'tool_requested' THEN 1 ELSE 0 END) OVER w, 0) AS rq, coalesce(sum(CASE WHEN event_type = 'tool_finished' THEN 1 ELSE 0 END) OVER w, 0) AS fi FROM v_trace WHERE call_id <> '' AND event_type IN ('tool_requested', 'tool_finished')
 WINDOW w AS (PARTITION BY session_id, call_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), b AS (SELECT session_id, sequence, CASE WHEN event_type = 'tool_requested' AND rq > 0 THEN 'duplicate_call_id' WHEN event_type = 'tool_finished' AND fi > 0 THEN 'duplicate_result'
 WHEN event_type = 'tool_finished' AND rq = 0 THEN 'result_without_request' END AS code FROM c), o AS (SELECT session_id, sequence, event_type, sum(CASE WHEN call_id = '' THEN 0 WHEN event_type = 'tool_requested' THEN 1 WHEN event_type = 'tool_finished' THEN -1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY sequence ROWS UNBOUNDED PRECEDING) AS open_calls FROM v_trace)
 SELECT * FROM b WHERE code IS NOT NULL UNION ALL SELECT session_id, sequence, 'pending_calls_at_response' FROM o WHERE event_type = 'model_response' AND open_calls <> 0""")
def trace_order_violations(spark, sf):
    return T.order_violations(_trace(spark, sf))


@query(W + """, x AS (SELECT event_id, unnest(list_filter([CASE WHEN event_type IN ('tool_requested', 'tool_finished') AND call_id = '' THEN 'missing_call_id' END, CASE WHEN event_type = 'tool_finished' AND tool_status IS NULL THEN 'missing_status' END,
 CASE WHEN event_type = 'policy_decision' AND decision IS NULL THEN 'missing_decision' END, CASE WHEN event_type = 'model_response' AND coalesce(content, '') = '' THEN 'empty_response' END, CASE WHEN sequence < 0 THEN 'negative_sequence' END], lambda v: v IS NOT NULL)) AS code FROM v_trace) SELECT * FROM x""")
def event_violations(spark, sf):
    return T.event_violations(_trace(spark, sf))


@query("SELECT 's' || CAST(conv_id AS VARCHAR) AS session_id, count(*) AS events, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous, count(DISTINCT turn) = count(*) AS unique_events FROM conversations GROUP BY conv_id")
def trace_scan_validity(spark, sf):
    return T.scan_validity(A.messages(spark, sf).withColumn("event_id", F.concat("session_id", F.lit("-"), F.col("sequence").cast("string"))))


ITEMS = """v_items AS (SELECT session_id, event_count, model_messages, tool_calls, unique_tools, tool_error_count, final_chars, coherent_order, closed_loop, multi_step_complex,
 CASE WHEN closed_loop AND multi_step_complex AND coherent_order THEN 'high_quality' WHEN closed_loop AND coherent_order THEN 'usable_but_failed_gate' WHEN r IS NOT NULL AND (s IS NOT NULL OR t IS NOT NULL) AND tool_calls >= 8 THEN 'incomplete_exploration' ELSE 'low_quality' END AS verdict,
 array_to_string(list_filter([CASE WHEN p IS NULL THEN 'no_patch' END, CASE WHEN t IS NULL THEN 'no_test_command' END, CASE WHEN final_chars = 0 THEN 'no_final_summary' END, CASE WHEN NOT coherent_order THEN 'weak_read_patch_test_order' END, CASE WHEN tool_error_count > 0 THEN 'tool_errors_observed' END], lambda v: v IS NOT NULL), ',') AS failure_reasons
 FROM (SELECT *, coalesce(r < p AND p < t, false) AS coherent_order, r IS NOT NULL AND p IS NOT NULL AND t IS NOT NULL AND l IS NOT NULL AS closed_loop, tool_calls >= 8 AND model_messages >= 6 AND unique_tools >= 4 AS multi_step_complex FROM (
 SELECT session_id, count(*) AS event_count, count(*) FILTER (event_type = 'model_response') AS model_messages, count(*) FILTER (event_type = 'tool_requested') AS tool_calls, count(DISTINCT CASE WHEN event_type = 'tool_requested' AND tool <> '' THEN tool END) AS unique_tools,
 count(*) FILTER (event_type = 'tool_finished' AND tool_status = 'failed') AS tool_error_count, length(coalesce(arg_max(content, sequence) FILTER (event_type = 'model_response' AND content <> ''), '')) AS final_chars,
 min(sequence) FILTER (event_type = 'tool_requested' AND tool = 'read_file') AS r, min(sequence) FILTER (event_type = 'tool_requested' AND tool = 'apply_patch') AS p, min(sequence) FILTER (event_type = 'tool_requested' AND tool = 'run_tests') AS t,
 min(sequence) FILTER (event_type = 'tool_requested' AND tool = 'search_files') AS s, min(sequence) FILTER (event_type = 'tool_requested' AND tool = 'list_files') AS l FROM v_trace GROUP BY session_id)))"""


@query(f"{W}, {ITEMS} SELECT * FROM v_items")
def trace_audit_items(spark, sf):
    return T.audit_items(_trace(spark, sf))


@query(f"""{W}, {ITEMS} SELECT count(*) AS reviewed, round(avg(CASE WHEN verdict = 'high_quality' THEN 1.0 ELSE 0.0 END), 6) AS high_quality_rate, round(avg(CASE WHEN closed_loop THEN 1.0 ELSE 0.0 END), 6) AS closed_loop_rate, round(avg(CASE WHEN coherent_order THEN 1.0 ELSE 0.0 END), 6) AS coherent_order_rate,
 round(avg(CASE WHEN multi_step_complex THEN 1.0 ELSE 0.0 END), 6) AS multi_step_complex_rate, min(tool_calls) AS tool_calls_min, round(avg(tool_calls), 6) AS tool_calls_mean, median(tool_calls) AS tool_calls_median, max(tool_calls) AS tool_calls_max FROM v_items""")
def trace_audit_summary(spark, sf):
    return T.audit_summary(T.audit_items(_trace(spark, sf)))


@query(f"{W}, {ITEMS} SELECT CAST(substr(session_id, 2) AS BIGINT) % 10 AS scenario, count(*) AS sessions, count(*) FILTER (verdict = 'high_quality') AS high_quality, count(*) FILTER (verdict = 'low_quality') AS low_quality, round(avg(tool_calls), 6) AS average_tool_calls FROM v_items GROUP BY 1")
def trace_audit_by_scenario(spark, sf):
    return T.audit_by(T.audit_items(_trace(spark, sf)), F.substring("session_id", 2, 30).cast("long") % 10, "scenario")


OUT = "v_out AS (SELECT session_id, CAST(sum(total_tokens) AS BIGINT) AS tokens, count(*) FILTER (event_type = 'tool_requested') AS tool_calls, count(*) FILTER (decision = 'deny') AS denied, coalesce(arg_max(tool_status, sequence) FILTER (event_type = 'tool_finished') = 'completed', false) AS success FROM v_trace GROUP BY session_id)"


@query(f"{W}, {OUT} SELECT * FROM v_out")
def trace_outcomes(spark, sf):
    return T.outcomes(_trace(spark, sf))


@query(W + "SELECT session_id, count(*) FILTER (event_type = 'policy_decision' AND decision <> 'allow') AS denied, count(*) FILTER (event_type = 'policy_decision' AND decision <> 'allow') = 0 AS passed, CASE WHEN count(*) FILTER (event_type = 'policy_decision' AND decision <> 'allow') = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM v_trace GROUP BY 1")
def policy_integrity(spark, sf):
    return T.policy_integrity(_trace(spark, sf))


@query(W + """SELECT session_id, call_id, arg_max(tool, sequence) FILTER (event_type = 'tool_requested') AS tool, coalesce(arg_max(tool_status, sequence) FILTER (event_type = 'tool_finished'), 'requested') AS status, count(*) FILTER (event_type = 'tool_requested') AS requests
 FROM v_trace WHERE call_id <> '' AND event_type IN ('tool_requested', 'tool_finished') GROUP BY 1, 2""")
def replay_state(spark, sf):
    return T.replayed_calls(_trace(spark, sf))


@query(W + """, s AS (SELECT session_id, sequence, CASE WHEN sequence % 37 = 5 THEN 'lost' ELSE sha256(session_id || CAST(sequence AS VARCHAR)) END AS before, sha256(session_id || CAST(sequence + 1 AS VARCHAR)) AS after FROM v_trace)
 SELECT session_id, sequence, expected, before FROM (SELECT *, lag(after) OVER (PARTITION BY session_id ORDER BY sequence) AS expected FROM s) WHERE expected IS NOT NULL AND expected <> before""")
def state_hash_chain(spark, sf):
    def state(n):
        return F.sha2(F.concat("session_id", n.cast("string")), 256)

    return T.state_chain(_trace(spark, sf).select("session_id", "sequence", F.when(F.col("sequence") % 37 == 5, "lost").otherwise(state(F.col("sequence"))).alias("before"), state(F.col("sequence") + 1).alias("after")))


@query(f"WITH {A.JOBS}, t AS (SELECT DISTINCT CAST(user_id * 50 AS VARCHAR) AS job_id FROM events) SELECT job_id, 'missing_trace' AS finding FROM v_jobs WHERE status = 'completed' AND job_id NOT IN (SELECT job_id FROM t) UNION ALL SELECT job_id, 'extra_trace' FROM t WHERE job_id NOT IN (SELECT job_id FROM v_jobs)")
def trace_job_reconciliation(spark, sf):
    return T.job_reconciliation(A.jobs(spark, sf), A.table(spark, sf, "events").select((F.col("user_id") * 50).cast("string").alias("job_id")).distinct())


STEPS = """v_steps AS (SELECT t.session_id, t.sequence, t.event_id, CASE t.event_type WHEN 'tool_finished' THEN 'environment' ELSE 'assistant' END AS role, CASE t.event_type WHEN 'model_response' THEN 'action' WHEN 'tool_requested' THEN 'action_metadata' ELSE 'execution_result' END AS step_type,
 CASE WHEN t.event_type = 'model_response' THEN 1 ELSE 0 END AS loss_mask, coalesce(r.reward, 0.0) AS reward FROM v_trace t LEFT JOIN v_rewards r USING (event_id) WHERE t.event_type IN ('model_response', 'tool_requested', 'tool_finished'))"""


@query(f"{W}, {REWARDS}, {STEPS} SELECT * FROM v_steps")
def rl_steps(spark, sf):
    return T.rl_steps(_trace(spark, sf))


@query(f"{W}, {REWARDS}, {STEPS}, {OUT} SELECT session_id, count(*) AS steps, CAST(sum(loss_mask) AS BIGINT) AS actions, coalesce(max(sequence) FILTER (loss_mask = 1), max(sequence)) AS outcome_sequence, round(sum(reward) + max(CASE WHEN success THEN 1.0 ELSE 0.0 END), 6) AS episode_return FROM v_steps JOIN v_out USING (session_id) GROUP BY session_id")
def rl_episodes(spark, sf):
    return T.rl_episodes(_trace(spark, sf))


@query("""SELECT conv_id, turn, CASE WHEN turn % 5 = 1 THEN 'ask_user' WHEN turn % 5 = 3 THEN 'tool_call' WHEN lower(text) LIKE '%confirm%' OR lower(text) LIKE '%proceed%' THEN 'confirm' WHEN length(trim(coalesce(text, ''))) > 0 THEN 'answer' ELSE 'stop' END AS action_type FROM conversations WHERE role = 'assistant'""")
def assistant_action_type(spark, sf):
    calls = F.when(F.col("turn") % 5 == 1, F.array(F.lit("ask_user"))).when(F.col("turn") % 5 == 3, F.array(F.lit("ask_user"), F.lit("read_file"))).otherwise(F.array().cast("array<string>"))
    return A.table(spark, sf, "conversations").where("role = 'assistant'").select("conv_id", "turn", T.action_type(F.col("text"), calls).alias("action_type"))


RESULTS = "v_results AS (SELECT l_orderkey AS job_id, CASE l_linestatus WHEN 'O' THEN 'hidden_command' ELSE 'agent_termination' END AS verifier, l_quantity > 10 AS passed, l_returnflag = 'R' AND l_quantity > 45 AS infra, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT) AS position FROM lineitem)"


def _results(spark, sf):
    return A.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("job_id"), F.when(F.col("l_linestatus") == "O", "hidden_command").otherwise("agent_termination").alias("verifier"), (F.col("l_quantity") > 10).alias("passed"), ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).alias("infra"), (F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_partkey") * 100 + F.col("l_quantity").cast("long")).alias("position")
    )


@query(f"WITH {RESULTS} SELECT job_id, bool_and(passed) AND NOT bool_or(infra) AS success, CASE WHEN bool_and(passed) AND NOT bool_or(infra) THEN 1 ELSE 0 END AS reward, count(*) AS results, bool_or(infra) AS infrastructure_failure FROM v_results GROUP BY job_id")
def evaluation_outcomes(spark, sf):
    return T.evaluation_outcomes(_results(spark, sf))


@query(f"WITH {RESULTS}, l AS (SELECT job_id, verifier, arg_max(passed, position) AS passed FROM v_results GROUP BY 1, 2) SELECT job_id, count(*) AS verifiers, count(*) FILTER (passed) AS passed, coalesce(bool_and(passed) FILTER (verifier <> 'agent_termination'), false) AS all_non_agent_passed FROM l GROUP BY 1")
def verifier_metrics(spark, sf):
    return T.verifier_metrics(_results(spark, sf))


RUNS = f"{A.JOBS}, v_runs AS (SELECT coalesce(nullif(scenario_id, ''), 'default') AS scenario_id, trace_id, success AS reward, CAST(job_id AS BIGINT) % 31 = 0 AS quarantined, status = 'infrastructure_failed' AS infra, CAST(job_id AS BIGINT) % 2 = 0 AS reproduced FROM v_jobs)"


def _runs(spark, sf):
    key = F.coalesce(F.nullif(F.col("scenario_id"), F.lit("")), F.lit("default"))
    n = F.col("job_id").cast("long")
    return A.jobs(spark, sf).select(key.alias("scenario_id"), "trace_id", F.col("success").alias("reward"), (n % 31 == 0).alias("quarantined"), (F.col("status") == "infrastructure_failed").alias("infra"), (n % 2 == 0).alias("reproduced"))


@query(f"WITH {RUNS} SELECT scenario_id, b.trace_id AS chosen, w.trace_id AS rejected, b.reward - w.reward AS margin FROM (SELECT scenario_id, max(struct_pack(reward := reward, trace_id := trace_id)) AS b, min(struct_pack(reward := reward, trace_id := trace_id)) AS w FROM v_runs WHERE NOT infra GROUP BY 1) WHERE b.reward > w.reward")
def preference_pairs(spark, sf):
    return T.preference_pairs(_runs(spark, sf).where("not infra"))


@query(W + "SELECT tool, count(*) AS n, count(DISTINCT session_id) AS sessions FROM v_trace WHERE event_type = 'tool_requested' GROUP BY 1")
def tool_use_counts(spark, sf):
    return T.counts(_trace(spark, sf), "tool", T.is_type("tool_requested"))


@query(W + "SELECT last_type, count(*) AS sessions FROM (SELECT session_id, arg_max(event_type, sequence) AS last_type FROM v_trace GROUP BY 1) GROUP BY 1")
def termination_counts(spark, sf):
    return _trace(spark, sf).groupBy("session_id").agg(F.max_by("event_type", "sequence").alias("last_type")).groupBy("last_type").agg(F.count("*").alias("sessions"))


@query(W + "SELECT session_id, sha256(string_agg(concat_ws('|', event_type, coalesce(tool, ''), coalesce(tool_status, ''), coalesce(content, '')), chr(10) ORDER BY sequence)) AS semantic_sha256 FROM v_trace GROUP BY 1")
def semantic_trace_hash(spark, sf):
    return T.semantic_hash(_trace(spark, sf))


@query(f"WITH {A.MESSAGES} SELECT session_id, sequence, prompt_messages, prompt_chars FROM (SELECT session_id, sequence, role, count(*) OVER w AS prompt_messages, CAST(coalesce(sum(length(content)) OVER w, 0) AS BIGINT) AS prompt_chars FROM v_msgs WINDOW w AS (PARTITION BY session_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE role = 'assistant'")
def prompt_fingerprints(spark, sf):
    return T.prompt_prefixes(A.messages(spark, sf))


_action = "CASE CAST(turn % 6 AS INTEGER) WHEN 0 THEN 'clarify' WHEN 1 THEN 'correct' WHEN 2 THEN 'refuse' WHEN 3 THEN 'confirm' ELSE NULL END"
_flags = {"contradictions": "turn % 5 = 4", "early_stops": "turn % 7 = 6", "disclosure_violations": "conv_id % 5 = 0 AND turn % 2 = 0", "unavailable_fact_requests": "conv_id % 7 = 0", "unavailable_fact_leaks": "conv_id % 7 = 0 AND turn % 3 = 0", "critical_simulator_errors": "conv_id % 11 = 0 AND turn % 4 = 1"}
TURNS = f"SELECT conv_id AS session_id, {_action} AS action, CASE WHEN role = 'assistant' THEN text END AS response, " + ", ".join(f"{c} AS {n}" for n, c in _flags.items()) + " FROM conversations"
GOALS = "SELECT conv_id AS session_id, g AS component, contains(lower(text), g) AS satisfied FROM conversations JOIN (VALUES ('the'), ('of the'), ('zzz')) t(g) ON conv_id % 3 <> 0"


@query(
    f"""WITH t AS ({TURNS}), g AS (SELECT session_id, count(*) AS n, count(*) FILTER (ok) AS d FROM (SELECT session_id, component, bool_or(coalesce(satisfied, false)) AS ok FROM ({GOALS}) GROUP BY 1, 2) GROUP BY 1),
 m AS (SELECT session_id, count(*) AS turns, {", ".join(f"count(*) FILTER (action = '{a}') AS {c}" for a, c in I.ACTIONS.items())}, {", ".join(f"count(*) FILTER ({c}) AS {c}" for c in I.FLAGS)}, count(response) AS responses, count(DISTINCT response) AS k FROM t GROUP BY 1)
 SELECT m.* EXCLUDE (k), coalesce(n, 0) AS goal_components_total, coalesce(d, 0) AS goal_components_satisfied, round(coalesce(k / CAST(nullif(responses, 0) AS DOUBLE), 0.0), 6) AS diversity, round(coalesce(d / CAST(nullif(n, 0) AS DOUBLE), 1.0), 6) AS goal_alignment, round(critical_simulator_errors / CAST(turns AS DOUBLE), 6) AS simulator_error_rate FROM m LEFT JOIN g USING (session_id)"""
)
def interaction_metrics(spark, sf):
    A.table(spark, sf, "conversations").createOrReplaceTempView("conversations")
    return I.interaction_metrics(spark.sql(TURNS), spark.sql(GOALS))


@query(f"WITH {A.MESSAGES} SELECT session_id, sequence, octet_length(encode(content)) + 1024 AS prompt_bound FROM v_msgs")
def token_bounds(spark, sf):
    return A.messages(spark, sf).select("session_id", "sequence", (F.octet_length("content").cast("long") + 1024).alias("prompt_bound"))


FLAGS = "CASE WHEN toxic = 1 THEN ['hidden_content_leak'] WHEN doc_id % 5 = 0 THEN ['duplicate_trace', 'odd_flag'] ELSE CAST([] AS VARCHAR[]) END"
TERM = "CASE doc_id % 4 WHEN 0 THEN 'completed' WHEN 1 THEN 'final_answer' WHEN 2 THEN 'max_turns' ELSE 'success' END"
WEIGHT = "CASE r " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.RISK_WEIGHTS.items()) + " ELSE 10 END"
RISK = f"""v_risk AS (SELECT *, CAST(declared + list_sum(list_transform(list_concat([0], [0]), lambda z: z)) + coalesce(list_sum([{WEIGHT} FOR r IN reasons]), 0) AS BIGINT) AS risk_score FROM (SELECT 't' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS trace_id, 's' || CAST(doc_id % 60 AS VARCHAR) AS scenario_id, quality = 1 AS success, doc_id % 3 AS declared, {TERM} AS termination,
 list_sort(list_distinct(list_concat({FLAGS}, list_filter([CASE WHEN quality <> 1 THEN 'unsuccessful' END, CASE WHEN doc_id % 4 = 2 THEN 'risky_termination' END], lambda x: x IS NOT NULL)))) AS reasons FROM labels))"""


def _risk(spark, sf):
    labels = A.table(spark, sf, "labels")
    flags = F.when(F.col("toxic") == 1, F.array(F.lit("hidden_content_leak"))).when(F.col("doc_id") % 5 == 0, F.array(F.lit("duplicate_trace"), F.lit("odd_flag"))).otherwise(F.array().cast("array<string>"))
    ends = F.element_at(F.array(*[F.lit(x) for x in ("completed", "final_answer", "max_turns", "success")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return V.risk(labels.select(F.concat(F.lit("t"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("trace_id"), F.concat(F.lit("s"), (F.col("doc_id") % 60).cast("string")).alias("scenario_id"), (F.col("quality") == 1).alias("success"), (F.col("doc_id") % 3).alias("declared"), ends.alias("termination"), flags.alias("flags")))


@query(f"WITH {RISK} SELECT trace_id, risk_score, array_to_string(reasons, ',') AS reasons FROM v_risk")
def risk_scores(spark, sf):
    return _risk(spark, sf).select("trace_id", "risk_score", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {RISK} SELECT trace_id, risk_score, CAST(row_number() OVER (ORDER BY risk_score DESC, scenario_id, trace_id) - 1 AS INTEGER) AS position FROM v_risk QUALIFY position < 40")
def review_queue_order(spark, sf):
    return V.queue(_risk(spark, sf), 40).select("trace_id", "risk_score", "position")


_item = "sha256('{\"position\":' || position || ',\"reasons\":[' || CASE WHEN len(reasons) = 0 THEN '' ELSE '\"' || array_to_string(reasons, '\",\"') || '\"' END || '],\"risk_score\":' || risk_score || ',\"scenario_id\":\"' || scenario_id || '\",\"trace_id\":\"' || trace_id || '\"}')"
QUEUE = f"{RISK}, v_q AS (SELECT trace_id, scenario_id, reasons, risk_score, CAST(row_number() OVER (ORDER BY risk_score DESC, scenario_id, trace_id) - 1 AS INTEGER) AS position FROM v_risk QUALIFY position < 40), v_sealed AS (SELECT *, {_item} AS item_sha256 FROM v_q)"


def _queue(spark, sf):
    return V.sealed(V.queue(_risk(spark, sf), 40).select("trace_id", "scenario_id", "reasons", "risk_score", "position"))


@query(f"WITH {QUEUE} SELECT count(*) AS items, sha256(string_agg(item_sha256, ',' ORDER BY position)) AS queue_sha256 FROM v_sealed")
def review_queue_seal(spark, sf):
    return V.seal(_queue(spark, sf))


@query(
    f"""WITH {QUEUE} SELECT trace_id, unnest(CASE WHEN position = 7 THEN ['missing'] WHEN position % 10 = 3 THEN ['item_sha256', 'risk_score'] WHEN position = 12 THEN ['doubled'] WHEN position = 5 THEN ['item_sha256'] ELSE [] END) AS code FROM v_q
 UNION ALL SELECT 'new', 'unexpected' UNION ALL SELECT NULL, 'items' UNION ALL SELECT NULL, 'queue_sha256'"""
)
def review_seal_violations(spark, sf):
    q = _queue(spark, sf)
    at = F.col("position")
    changed = q.where(at != 7).withColumn("risk_score", F.col("risk_score") + F.when(at % 10 == 3, 1).otherwise(0)).withColumn("item_sha256", F.when(at == 5, "x").otherwise(F.col("item_sha256")))
    odd = V.sealed(q.where(at == 0).withColumn("trace_id", F.lit("new")).drop("item_sha256"))
    return V.seal_violations(changed.unionByName(q.where(at == 12)).unionByName(odd), V.seal(q), _risk(spark, sf), 40)


@query(f"""WITH {RISK}, q AS (SELECT * FROM v_risk ORDER BY risk_score DESC, scenario_id, trace_id LIMIT 40), a AS (SELECT 'scenario_id' AS field, scenario_id AS value FROM v_risk UNION SELECT 'success', CAST(success AS VARCHAR) FROM v_risk UNION SELECT 'termination', termination FROM v_risk),
 b AS (SELECT 'scenario_id' AS field, scenario_id AS value FROM q UNION SELECT 'success', CAST(success AS VARCHAR) FROM q UNION SELECT 'termination', termination FROM q) SELECT a.field, count(*) AS available, count(b.value) AS covered, count(*) = count(b.value) AS complete FROM a LEFT JOIN b ON a.field = b.field AND a.value = b.value GROUP BY 1""")
def review_coverage(spark, sf):
    r = _risk(spark, sf)
    return V.coverage(r, V.queue(r, 40), ["scenario_id", "success", "termination"])


DECISIONS = "v_dec AS (SELECT 't' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS trace_id, CASE WHEN n_chars % 9 = 0 THEN 'critical' WHEN n_chars % 5 = 0 THEN 'needs_work' ELSE 'acceptable' END AS verdict, n_chars % 18 = 0 AS quarantine FROM documents WHERE doc_id % 3 <> 1)"


def _decisions(spark, sf):
    d = A.table(spark, sf, "documents").where("doc_id % 3 <> 1")
    return d.select(F.concat(F.lit("t"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("trace_id"), F.when(F.col("n_chars") % 9 == 0, "critical").when(F.col("n_chars") % 5 == 0, "needs_work").otherwise("acceptable").alias("verdict"), (F.col("n_chars") % 18 == 0).alias("quarantine"))


@query(f"""WITH {RISK}, {DECISIONS}, m AS (SELECT r.trace_id AS wanted, d.trace_id AS got, verdict, quarantine FROM v_risk r FULL OUTER JOIN v_dec d ON r.trace_id = d.trace_id),
 g AS (SELECT count(wanted) AS required, count(*) FILTER (got IS NULL) AS missing, count(*) FILTER (wanted IS NULL) AS unexpected, CAST(0 AS BIGINT) AS duplicates, count(*) FILTER (wanted IS NOT NULL AND verdict = 'critical' AND NOT quarantine) AS critical_open, count(*) FILTER (wanted IS NOT NULL AND verdict = 'acceptable') AS acceptable FROM m)
 SELECT *, round(acceptable / CAST(required AS DOUBLE), 6) AS acceptable_rate, missing + unexpected + duplicates + critical_open = 0 AND acceptable / CAST(required AS DOUBLE) >= 0.9 AS passed FROM g""")
def review_gate(spark, sf):
    return V.gate(_risk(spark, sf), _decisions(spark, sf), 0.9)


@query(f"WITH {RISK}, {DECISIONS} SELECT DISTINCT trace_id FROM v_dec WHERE quarantine AND trace_id IN (SELECT trace_id FROM v_risk)")
def quarantine_set(spark, sf):
    return V.quarantine(_risk(spark, sf), _decisions(spark, sf))


@query(f"WITH {RISK} SELECT trace_id, risk_score + 1 AS risk_score, risk_score AS recomputed FROM v_risk WHERE CAST(substr(trace_id, 2) AS BIGINT) % 10 = 0")
def review_gate_revalidation(spark, sf):
    r = _risk(spark, sf)
    recorded = r.withColumn("risk_score", F.col("risk_score") + F.when(F.substring("trace_id", 2, 20).cast("long") % 10 == 0, 1).otherwise(0))
    return V.changed(recorded, r)


@query("SELECT doc_id, CAST(line AS INTEGER) AS line, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents) WHERE contains(text, 'License')")
def text_search_lines(spark, sf):
    d = A.table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return d.where(F.contains("text", F.lit("License"))).select("doc_id", (F.col("line") + 1).alias("line"), "text")


@query("SELECT doc_id, md5(replace(replace(text, 'the', '[redacted]'), 'License', '[redacted]')) AS text_md5 FROM documents")
def redact_values(spark, sf):
    from trajlake.functions.text import redacted

    return A.table(spark, sf, "documents").select("doc_id", F.md5(redacted(F.col("text"), ["the", "License"]).cast("binary")).alias("text_md5"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS canonical FROM events")
def canonical_timestamps(spark, sf):
    return A.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("canonical"))


