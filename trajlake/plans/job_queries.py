"""Queries over job tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from trajlake.operators import jobs as J
from trajlake.plans import adapters as A
from trajlake.plans.registry import query

KEY = "coalesce(nullif(scenario_id, ''), 'default')"
W = f"WITH {A.JOBS} "


@query(W + "SELECT status, count(*) AS jobs FROM v_jobs GROUP BY status")
def job_status_counts(spark, sf):
    return J.status_counts(A.jobs(spark, sf))


@query(W + "SELECT job_id, status FROM v_jobs WHERE status NOT IN ('pending', 'running') AND job_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 3 = 0)")
def reportable_rows(spark, sf):
    chosen = A.table(spark, sf, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("string").alias("job_id"))
    return J.reportable(A.jobs(spark, sf), chosen).select("job_id", "status")


@query(
    W + f"""SELECT a.*, g.* FROM (SELECT count(*) AS rollouts, count(DISTINCT nullif(scenario_id, '')) AS scenario_count, CAST(sum(success) AS BIGINT) AS successes,
 round(sum(success) / CAST(count(*) AS DOUBLE), 6) AS success_rate, round(stddev_pop(CAST(success AS DOUBLE)), 6) AS episode_reward_std,
 count(DISTINCT nullif(trace_id, '')) AS unique_traces, count(nullif(trace_id, '')) - count(DISTINCT nullif(trace_id, '')) AS duplicate_traces,
 count(*) FILTER (status = 'infrastructure_failed') AS infrastructure_failures FROM v_jobs) a,
 (SELECT round(avg(CAST(any_ok AS DOUBLE)), 6) AS pass_at_observed_k, round(coalesce(avg(CASE WHEN n > 1 THEN sd END), 0.0), 6) AS in_group_reward_std_mean,
 count(*) FILTER (n > 1 AND sd = 0) AS low_information_groups FROM (SELECT count(*) AS n, max(success) AS any_ok, stddev_pop(CAST(success AS DOUBLE)) AS sd FROM v_jobs GROUP BY {KEY})) g"""
)
def quality_report(spark, sf):
    return J.quality_report(A.jobs(spark, sf))


@query(
    W + """SELECT metric, round(sum(v) / (SELECT count(*) FROM v_jobs), 6) AS average FROM (SELECT 'tool_calls' AS metric, m_tool_calls AS v FROM v_jobs UNION ALL
 SELECT 'verifier_hidden_command_passed', m_hidden FROM v_jobs UNION ALL SELECT 'verifier_all_non_agent_passed', m_all FROM v_jobs UNION ALL
 SELECT 'verifier_agent_termination_passed', m_stop FROM v_jobs) GROUP BY metric"""
)
def metric_averages(spark, sf):
    return J.metric_averages(A.jobs(spark, sf))


@query(W + "SELECT goal_type, count(*) AS rollouts, round(sum(success) / CAST(count(*) AS DOUBLE), 6) AS success_rate FROM v_jobs WHERE goal_type <> '' GROUP BY goal_type")
def success_by_goal_type(spark, sf):
    return J.success_by(A.jobs(spark, sf), "goal_type")


@query(W + f"SELECT {KEY} AS scenario_id, count(*) AS rollouts, round(avg(CAST(success AS DOUBLE)), 6) AS reward_mean, round(stddev_pop(CAST(success AS DOUBLE)), 6) AS reward_std FROM v_jobs GROUP BY 1")
def reward_group_stats(spark, sf):
    return J.reward_groups(A.jobs(spark, sf))


@query(W + f"SELECT {KEY} AS scenario_id, count(*) AS rollouts, CAST(sum(success) AS BIGINT) AS successes, CAST(max(success) AS DOUBLE) AS pass_at_k, round(sum(success) / CAST(count(*) AS DOUBLE), 6) AS success_rate FROM v_jobs GROUP BY 1")
def pass_at_k(spark, sf):
    return J.pass_at_k(A.jobs(spark, sf))


REPORT = f"""v_report AS (SELECT {KEY} AS scenario_id, count(*) AS rollouts, CAST(sum(success) AS BIGINT) AS successes, round(sum(success) / CAST(count(*) AS DOUBLE), 6) AS success_rate,
 round(avg(coalesce(m_hidden, 0.0)), 6) AS hidden_command_pass_rate, round(avg(coalesce(m_all, 0.0)), 6) AS all_non_agent_pass_rate, round(avg(coalesce(m_stop, 0.0)), 6) AS agent_stop_rate,
 count(*) FILTER (status = 'infrastructure_failed') AS infrastructure_failures, round(count(*) FILTER (status = 'infrastructure_failed') / CAST(count(*) AS DOUBLE), 6) AS infrastructure_failure_rate,
 round(avg(m_tool_calls), 6) AS average_tool_calls, round(avg(CAST(coalesce(tokens, 0) AS DOUBLE)), 6) AS average_tokens FROM v_jobs GROUP BY 1)"""


@query(W + f", {REPORT} SELECT * FROM v_report")
def scenario_quality(spark, sf):
    return J.scenario_quality(A.jobs(spark, sf))


LIMITS = {"rollouts": 2, "success_rate": 0.1, "hidden_command_pass_rate": 0.2, "all_non_agent_pass_rate": 0.4, "infrastructure_failure_rate": 0.5, "average_tool_calls": 5.0}


@query(
    W + f""", {REPORT} SELECT scenario_id, f AS candidate_failures, f = '' AS scale_candidate FROM (SELECT scenario_id, array_to_string(list_filter([
 CASE WHEN rollouts < 2 THEN 'rollouts' END, CASE WHEN success_rate < 0.1 THEN 'success_rate' END, CASE WHEN hidden_command_pass_rate < 0.2 THEN 'hidden_command_pass_rate' END,
 CASE WHEN all_non_agent_pass_rate < 0.4 THEN 'all_non_agent_pass_rate' END, CASE WHEN infrastructure_failure_rate > 0.5 THEN 'infrastructure_failure_rate' END,
 CASE WHEN average_tool_calls < 5.0 THEN 'average_tool_calls' END], lambda x: x IS NOT NULL), ',') AS f FROM v_report)"""
)
def scale_candidates(spark, sf):
    return J.scale_candidates(J.scenario_quality(A.jobs(spark, sf)), LIMITS)


@query(
    W + """SELECT rollouts, f AS failures, CASE WHEN f = '' THEN 'continue' ELSE 'hold' END AS decision, CASE WHEN f LIKE '%infrastructure%' THEN 'fix_infrastructure' WHEN f = '' THEN 'run_next_shard' ELSE 'review_failures' END AS next_action
 FROM (SELECT rollouts, array_to_string(list_filter([CASE WHEN sr < 0.5 THEN 'success_rate' END, CASE WHEN ut < 100 THEN 'unique_traces' END, CASE WHEN inf > 10 THEN 'infrastructure_failures' END], lambda x: x IS NOT NULL), ',') AS f
 FROM (SELECT count(*) AS rollouts, round(sum(success) / CAST(count(*) AS DOUBLE), 6) AS sr, count(DISTINCT trace_id) AS ut, count(*) FILTER (status = 'infrastructure_failed') AS inf FROM v_jobs))"""
)
def continuation_decision(spark, sf):
    return J.continuation(J.quality_report(A.jobs(spark, sf)), 0.5, 100, 10)


EST = f"""v_seen AS (SELECT {KEY} AS s, tokens FROM v_jobs WHERE status NOT IN ('pending', 'running') AND tokens > 0),
 v_mean AS (SELECT s, avg(tokens) AS m FROM v_seen GROUP BY s),
 v_est AS (SELECT job_id, {KEY} AS scenario_id, coalesce(m, (SELECT avg(tokens) FROM v_seen)) AS estimate FROM v_jobs LEFT JOIN v_mean ON s = {KEY} WHERE status IN ('pending', 'running'))"""


@query(W + f", {EST} SELECT scenario_id, count(*) AS pending_jobs, round(max(estimate), 4) AS observed_average_tokens, round(sum(estimate), 2) AS estimated_tokens FROM v_est GROUP BY scenario_id")
def scale_estimate(spark, sf):
    return J.scale_estimate(A.jobs(spark, sf))


@query(
    W + f""", {EST} SELECT CAST(floor((rn - 1) / 20) AS BIGINT) AS shard_index, count(*) AS max_jobs, min(job_id) AS first_job_id, max(job_id) AS last_job_id, round(sum(estimate), 2) AS estimated_tokens, round(sum(estimate) / 1000000 * 3.0, 4) AS estimated_cost
 FROM (SELECT *, row_number() OVER (ORDER BY job_id) AS rn FROM v_est) GROUP BY 1"""
)
def scale_shards(spark, sf):
    return J.scale_shards(A.jobs(spark, sf), 20, 3.0)


@query(
    W + """SELECT count(*) AS selected_jobs, count(status) AS found_jobs, count(*) - count(status) AS missing_jobs, count(*) FILTER (status = 'completed') AS completed_jobs, CAST(coalesce(sum(success), 0) AS BIGINT) AS successes,
 round(sum(success) / CAST(count(status) AS DOUBLE), 6) AS success_rate, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS tokens, count(status) > 0 AND count(*) = count(status) AND count(*) FILTER (status IN ('completed', 'failed', 'infrastructure_failed')) = count(status) AS all_selected_terminal
 FROM (SELECT DISTINCT CAST(l_orderkey + 7 AS VARCHAR) AS job_id FROM lineitem WHERE l_linenumber = 1) LEFT JOIN v_jobs USING (job_id)"""
)
def selected_job_status(spark, sf):
    asked = A.table(spark, sf, "lineitem").where("l_linenumber = 1").select((F.col("l_orderkey") + 7).cast("string").alias("job_id"))
    return J.selected_status(A.jobs(spark, sf), asked)


@query(
    W + """, r AS (SELECT job_id, tokens, row_number() OVER (ORDER BY job_id) AS rn, sum(tokens) OVER (ORDER BY job_id) AS used FROM v_jobs)
 SELECT job_id, rn AS position, CAST(used AS BIGINT) AS used FROM r WHERE rn < (SELECT min(rn) FROM r WHERE used > 50000000)"""
)
def budget_prefix_admission(spark, sf):
    return J.budget_prefix(A.jobs(spark, sf), 50_000_000)


@query(
    W + """SELECT job_id, status AS outcome, attempts, CASE WHEN status IN ('pending', 'running') THEN 'pending' WHEN status = 'infrastructure_failed' AND attempts <= 1 THEN 'pending'
 WHEN status = 'infrastructure_failed' THEN 'infrastructure_failed' WHEN coalesce(trace_id, '') <> '' THEN 'completed' ELSE 'failed' END AS next_status FROM v_jobs"""
)
def job_state_transitions(spark, sf):
    return J.transitions(A.jobs(spark, sf), 1)


C = f"WITH {A.CALLS} "


@query(
    C + """SELECT job_id, position, total, earlier FROM (SELECT *, max(total) OVER (PARTITION BY job_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
 FROM (SELECT job_id, CAST(row_number() OVER (PARTITION BY job_id ORDER BY call_index, part, prompt_tokens, happened_at) AS BIGINT) AS position, prompt_tokens AS total FROM v_calls)) WHERE total < 0 OR total < earlier"""
)
def usage_monotonic_violations(spark, sf):
    c = A.calls(spark, sf)
    place = F.row_number().over(Window.partitionBy("job_id").orderBy("call_index", "part", "prompt_tokens", "happened_at"))
    return J.usage_decreases(c.select("job_id", place.cast("long").alias("position"), F.col("prompt_tokens").alias("total")))


@query(
    "SELECT count(*) AS jobs, CAST(sum(coalesce(CASE WHEN o_orderkey % 2 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) + 5 END, CAST(floor(o_totalprice) AS BIGINT))) AS BIGINT) AS tokens, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 6))) AS DOUBLE) AS cost FROM orders"
)
def scheduler_totals(spark, sf):
    o = A.table(spark, sf, "orders").select(F.floor("o_totalprice").cast("long").alias("tokens"), F.when(F.col("o_orderkey") % 2 == 0, F.floor("o_totalprice").cast("long") + 5).alias("consumed_tokens"), F.lit(None).cast("double").alias("consumed_cost"), F.col("o_totalprice").alias("cost"))
    return J.scheduler_totals(o)


@query(W + "SELECT job_id, success, m_tool_calls AS tool_calls, tokens FROM v_jobs ORDER BY success DESC, m_tool_calls, tokens, job_id LIMIT 200")
def rank_reports(spark, sf):
    reports = A.jobs(spark, sf).select("job_id", "success", F.col("metrics")["tool_calls"].alias("tool_calls"), "tokens")
    return J.ranked_reports(reports, ["success"], ["tool_calls", "tokens"], "job_id", 200)


@query(W + "SELECT job_id, status FROM v_jobs ORDER BY CASE WHEN status = 'completed' THEN 1 ELSE 0 END, status, job_id LIMIT 50")
def review_sample_rows(spark, sf):
    return J.review_sample(A.jobs(spark, sf), 50)


@query(W + "SELECT job_id FROM v_jobs ORDER BY job_id LIMIT 100 OFFSET 300")
def task_page(spark, sf):
    return J.page(A.jobs(spark, sf).select("job_id"), "job_id", 300, 100)


@query(
    W + """SELECT job_id, status FROM v_jobs WHERE CAST(job_id AS BIGINT) % 2 = 0 UNION ALL SELECT job_id, status FROM (SELECT CAST(l_orderkey AS VARCHAR) AS job_id, 'pending' AS status,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1 AND job_id NOT IN (SELECT job_id FROM v_jobs WHERE CAST(job_id AS BIGINT) % 2 = 0)"""
)
def insert_or_ignore(spark, sf):
    existing = A.jobs(spark, sf).where("cast(job_id as bigint) % 2 = 0").select("job_id", "status")
    place = F.struct("l_linenumber", "l_partkey")
    submitted = A.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("job_id"), F.lit("pending").alias("status"), place.alias("position"))
    return J.new_jobs(existing, submitted).select("job_id", "status")


@query(W + """SELECT CAST(floor((rn - 1) / 64) AS BIGINT) AS shard_index, count(*) AS tasks, min(job_id) AS first_id, max(job_id) AS last_id FROM (SELECT job_id, row_number() OVER (ORDER BY job_id) AS rn FROM v_jobs) GROUP BY 1""")
def shard_schedule(spark, sf):
    shard = F.floor((F.col("rn") - 1) / 64).cast("long")
    return J.numbered(A.jobs(spark, sf).select("job_id"), "job_id").groupBy(shard.alias("shard_index")).agg(F.count("*").alias("tasks"), F.min("job_id").alias("first_id"), F.max("job_id").alias("last_id"))


@query("SELECT DISTINCT 'job_' || substr(sha256(concat_ws(':', 'scenario_' || CAST(o_custkey AS VARCHAR), CAST(o_orderkey % 4 AS VARCHAR), o_orderpriority, o_orderstatus)), 1, 20) AS job_id FROM orders")
def job_ids(spark, sf):
    o = A.table(spark, sf, "orders")
    return o.select(F.concat(F.lit("job_"), F.substring(F.sha2(F.concat_ws(":", F.concat(F.lit("scenario_"), F.col("o_custkey").cast("string")), (F.col("o_orderkey") % 4).cast("string"), "o_orderpriority", "o_orderstatus"), 256), 1, 20)).alias("job_id")).distinct()


@query(
    "WITH " + A.CALLS + """ SELECT job_id, count(*) AS calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(least(cached_tokens, prompt_tokens)) AS BIGINT) AS cached_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
 CAST(round(CAST(sum((prompt_tokens - least(cached_tokens, prompt_tokens)) * 300 + least(cached_tokens, prompt_tokens) * 30 + completion_tokens * 1500) AS DECIMAL(28, 0)) / 100000000, 8) AS DOUBLE) AS cost_usd FROM v_calls GROUP BY job_id"""
)
def usage_cost(spark, sf):
    from trajlake.operators.usage import cost_by_job

    return cost_by_job(A.calls(spark, sf), uncached="3.00", cached="0.30", output="15.00")


@query("WITH " + A.CALLS + " SELECT 'prompt_tokens' AS path, CAST(sum(prompt_tokens) AS BIGINT) AS total FROM v_calls UNION ALL SELECT 'prompt_tokens_details.cached_tokens', CAST(sum(cached_tokens) AS BIGINT) FROM v_calls UNION ALL SELECT 'completion_tokens', CAST(sum(completion_tokens) AS BIGINT) FROM v_calls")
def usage_totals(spark, sf):
    from trajlake.operators.usage import totals

    return totals(A.calls(spark, sf).select(F.struct("prompt_tokens", "completion_tokens", F.struct("cached_tokens").alias("prompt_tokens_details")).alias("usage")), "usage")


@query(
    "WITH " + A.CALLS + """ SELECT job_id, count(*) AS started, count(*) FILTER (flag <> 'R') AS completed, count(*) FILTER (flag = 'R') AS open_calls, count(*) - count(DISTINCT call_index) AS repeated_indexes, CAST(coalesce(sum(prompt_tokens + completion_tokens) FILTER (flag <> 'R'), 0) AS BIGINT) AS charged
 FROM v_calls GROUP BY job_id"""
)
def usage_ledger_audit(spark, sf):
    from trajlake.operators.usage import ledger_audit

    c = A.calls(spark, sf)
    started = c.select("job_id", "call_index", "part", "happened_at")
    completed = c.where("flag <> 'R'").select("job_id", "call_index", "part", "happened_at", (F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens"))
    return ledger_audit(started, completed, ["part", "happened_at"])


@query(
    "WITH " + A.CALLS + """ SELECT job_id, call_index, part, array_to_string(list_filter([CASE WHEN cached_tokens > prompt_tokens THEN 'cached_exceeds_prompt' END, CASE WHEN prompt_tokens + completion_tokens > 4500 THEN 'total_exceeds_limit' END, CASE WHEN completion_tokens = 0 THEN 'no_output' END], lambda x: x IS NOT NULL), ',') AS violations
 FROM v_calls WHERE cached_tokens > prompt_tokens OR prompt_tokens + completion_tokens > 4500 OR completion_tokens = 0"""
)
def token_bound_violations(spark, sf):
    from trajlake.operators.usage import bound_violations

    return bound_violations(A.calls(spark, sf), 4500).select("job_id", "call_index", "part", "violations")
