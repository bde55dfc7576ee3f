"""Event traces: order rules, turn rewards, audits, replay and training views.

A trace has session_id, sequence (from 0), event_id, event_type, call_id, tool, tool_status, decision,
content. Folds over a session are windows over (session_id, sequence); a session is one agent run,
bounded by its budget, so its partition is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def session() -> WindowSpec:
    return Window.partitionBy("session_id").orderBy("sequence")


def so_far() -> WindowSpec:
    return session().rowsBetween(Window.unboundedPreceding, 0)


def of_call() -> WindowSpec:
    return Window.partitionBy("session_id", "call_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, 0)


def is_type(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def turn_rewards(trace: DataFrame) -> DataFrame:
    """Reward per event: asking the user, denied actions and finished tools, with the turn and the tool's name."""
    turns = F.sum(is_type("model_response").cast("int")).over(so_far())
    # calls are requests without a call id too: those share the blank one, like any other key
    asked = F.last(F.when(is_type("tool_requested"), F.col("tool")), ignorenulls=True).over(of_call())
    reward = (
        F.when(is_type("tool_requested") & (F.col("tool") == "ask_user"), 0.2)
        .when(is_type("policy_decision") & (F.col("decision") != "allow"), -1.0)
        .when(is_type("tool_finished"), F.when(F.col("tool_status") == "completed", 0.1).otherwise(-0.1))
    )
    kind = F.when(is_type("tool_requested"), "information_gathering").when(is_type("policy_decision"), "policy").otherwise("tool_execution")
    rows = trace.withColumn("turn_index", F.greatest(F.coalesce(turns, F.lit(0)) - 1, F.lit(0)).cast("int")).withColumn("asked", asked)
    action = F.when(is_type("tool_requested"), "ask_user").otherwise(F.coalesce("asked", F.lit("tool_call")))
    return rows.select("session_id", "sequence", "event_id", "turn_index", kind.alias("kind"), action.alias("action_type"), reward.alias("reward")).where("reward is not null")


def reward_metrics(rewards: DataFrame) -> DataFrame:
    return rewards.groupBy("session_id").agg(
        F.round(F.sum("reward"), 6).alias("turn_reward_total"), F.round(F.avg("reward"), 6).alias("turn_reward_mean"), F.count(F.when(F.col("reward") > 0, 1)).alias("positive_turn_rewards"), F.count(F.when(F.col("reward") < 0, 1)).alias("negative_turn_rewards")
    )


def public_rewards(rewards: DataFrame, public: tuple[str, ...] = ("information_gathering", "policy")) -> DataFrame:
    """Rewards fit for export: unknown kinds become "other", reasons are general, the tool's name is hashed."""
    kind = F.when(F.col("kind").isin(*public), F.col("kind")).otherwise("other")
    reason = F.when(F.col("reward") > 0, "positive").when(F.col("reward") < 0, "negative").otherwise("neutral")
    return rewards.select("event_id", "turn_index", kind.alias("kind"), reason.alias("reason"), F.sha2("action_type", 256).alias("action_sha256"), "reward")


def order_violations(trace: DataFrame) -> DataFrame:
    """session_id, sequence and code where the order rules break: repeated, unanswered or unasked calls."""
    calls = trace.where(F.col("call_id") != "").where(is_type("tool_requested", "tool_finished"))
    per_call = Window.partitionBy("session_id", "call_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    earlier = {kind: F.coalesce(F.sum(is_type(kind).cast("int")).over(per_call), F.lit(0)) for kind in ("tool_requested", "tool_finished")}
    code = (
        F.when(is_type("tool_requested") & (earlier["tool_requested"] > 0), "duplicate_call_id")
        .when(is_type("tool_finished") & (earlier["tool_finished"] > 0), "duplicate_result")
        .when(is_type("tool_finished") & (earlier["tool_requested"] == 0), "result_without_request")
    )
    bad = calls.select("session_id", "sequence", code.alias("code")).where("code is not null")
    issued = F.sum((is_type("tool_requested") & (F.col("call_id") != "")).cast("int")).over(so_far())
    answered = F.sum((is_type("tool_finished") & (F.col("call_id") != "")).cast("int")).over(so_far())
    waiting = trace.withColumn("open", issued - answered).where(is_type("model_response") & (F.col("open") != 0))
    return bad.unionByName(waiting.select("session_id", "sequence", F.lit("pending_calls_at_response").alias("code")))


def event_violations(trace: DataFrame) -> DataFrame:
    """Fields that an event of its type must have and lacks."""
    rules = F.array_compact(
        F.array(
            F.when(is_type("tool_requested", "tool_finished") & (F.col("call_id") == ""), "missing_call_id"),
            F.when(is_type("tool_finished") & F.col("tool_status").isNull(), "missing_status"),
            F.when(is_type("policy_decision") & F.col("decision").isNull(), "missing_decision"),
            F.when(is_type("model_response") & (F.coalesce(F.col("content"), F.lit("")) == ""), "empty_response"),
            F.when(F.col("sequence") < 0, "negative_sequence"),
        )
    )
    return trace.select("event_id", F.explode(rules).alias("code"))


def scan_validity(trace: DataFrame) -> DataFrame:
    """Per session: events, whether sequences are contiguous from 0, and whether event ids are unique."""
    return trace.groupBy("session_id").agg(F.count("*").alias("events"), ((F.min("sequence") == 0) & (F.max("sequence") == F.count("*") - 1) & (F.countDistinct("sequence") == F.count("*"))).alias("contiguous"), (F.countDistinct("event_id") == F.count("*")).alias("unique_events"))


def audit_items(trace: DataFrame) -> DataFrame:
    """Per session the figures and verdict of a logical audit."""
    requested = is_type("tool_requested")

    def first(*tools: str) -> Column:
        return F.min(F.when(requested & F.col("tool").isin(*tools), F.col("sequence")))

    grouped = trace.groupBy("session_id").agg(
        F.count("*").alias("event_count"),
        F.count(F.when(is_type("model_response"), 1)).alias("model_messages"),
        F.count(F.when(requested, 1)).alias("tool_calls"),
        F.countDistinct(F.when(requested & (F.col("tool") != ""), F.col("tool"))).alias("unique_tools"),
        F.count(F.when(is_type("tool_finished") & (F.col("tool_status") == "failed"), 1)).alias("tool_error_count"),
        F.length(F.coalesce(F.max_by("content", F.when(is_type("model_response") & (F.col("content") != ""), F.col("sequence"))), F.lit(""))).cast("long").alias("final_chars"),
        first("read_file").alias("first_read"),
        first("apply_patch").alias("first_patch"),
        first("run_tests").alias("first_test"),
        first("search_files").isNotNull().alias("has_search"),
        first("list_files").isNotNull().alias("has_status"),
    )
    read, patch, test = (F.col(f"first_{x}").isNotNull() for x in ("read", "patch", "test"))
    marked = grouped.select(
        "*",
        F.coalesce((F.col("first_read") < F.col("first_patch")) & (F.col("first_patch") < F.col("first_test")), F.lit(False)).alias("coherent_order"),
        (read & patch & test & F.col("has_status")).alias("closed_loop"),
        ((F.col("tool_calls") >= 8) & (F.col("model_messages") >= 6) & (F.col("unique_tools") >= 4)).alias("multi_step_complex"),
    )
    verdict = (
        F.when(F.col("closed_loop") & F.col("multi_step_complex") & F.col("coherent_order"), "high_quality")
        .when(F.col("closed_loop") & F.col("coherent_order"), "usable_but_failed_gate")
        .when(read & (F.col("has_search") | test) & (F.col("tool_calls") >= 8), "incomplete_exploration")
        .otherwise("low_quality")
    )
    reasons = F.array_compact(F.array(F.when(~patch, "no_patch"), F.when(~test, "no_test_command"), F.when(F.col("final_chars") == 0, "no_final_summary"), F.when(~F.col("coherent_order"), "weak_read_patch_test_order"), F.when(F.col("tool_error_count") > 0, "tool_errors_observed")))
    return marked.select("session_id", "event_count", "model_messages", "tool_calls", "unique_tools", "tool_error_count", "final_chars", "coherent_order", "closed_loop", "multi_step_complex", verdict.alias("verdict"), F.array_join(reasons, ",").alias("failure_reasons"))


def audit_summary(items: DataFrame) -> DataFrame:
    """One row of rates and figures over all audited sessions."""

    def rate(c: Column) -> Column:
        return F.round(F.avg(c.cast("double")), 6)

    return items.agg(
        F.count("*").alias("reviewed"), rate(F.col("verdict") == "high_quality").alias("high_quality_rate"), rate(F.col("closed_loop")).alias("closed_loop_rate"), rate(F.col("coherent_order")).alias("coherent_order_rate"), rate(F.col("multi_step_complex")).alias("multi_step_complex_rate"),
        F.min("tool_calls").alias("tool_calls_min"), F.round(F.avg("tool_calls"), 6).alias("tool_calls_mean"), F.median("tool_calls").alias("tool_calls_median"), F.max("tool_calls").alias("tool_calls_max"),
    )


def audit_by(items: DataFrame, key: Column, name: str) -> DataFrame:
    return items.groupBy(key.alias(name)).agg(F.count("*").alias("sessions"), F.count(F.when(F.col("verdict") == "high_quality", 1)).alias("high_quality"), F.count(F.when(F.col("verdict") == "low_quality", 1)).alias("low_quality"), F.round(F.avg("tool_calls"), 6).alias("average_tool_calls"))


def outcomes(trace: DataFrame) -> DataFrame:
    """Per session: tokens, tool calls, denials and success (no failed tool at the end)."""
    return trace.groupBy("session_id").agg(
        F.sum("total_tokens").cast("long").alias("tokens"), F.count(F.when(is_type("tool_requested"), 1)).alias("tool_calls"), F.count(F.when(F.col("decision") == "deny", 1)).alias("denied"), F.coalesce(F.max_by("tool_status", F.when(is_type("tool_finished"), F.col("sequence"))) == "completed", F.lit(False)).alias("success")
    )


def policy_integrity(trace: DataFrame) -> DataFrame:
    denied = F.count(F.when(is_type("policy_decision") & (F.col("decision") != "allow"), 1))
    return trace.groupBy("session_id").agg(denied.alias("denied"), (denied == 0).alias("passed"), F.when(denied == 0, 1.0).otherwise(0.0).alias("score"))


def replayed_calls(trace: DataFrame) -> DataFrame:
    """Last state of every call of a session: its tool, its status and how often it was asked."""
    calls = trace.where((F.col("call_id") != "") & is_type("tool_requested", "tool_finished"))
    return calls.groupBy("session_id", "call_id").agg(
        F.max_by("tool", F.when(is_type("tool_requested"), F.col("sequence"))).alias("tool"), F.coalesce(F.max_by("tool_status", F.when(is_type("tool_finished"), F.col("sequence"))), F.lit("requested")).alias("status"), F.count(F.when(is_type("tool_requested"), 1)).alias("requests")
    )


def state_chain(trace: DataFrame) -> DataFrame:
    """Events whose state before is not the state that the event before left; states: before, after."""
    return trace.withColumn("expected", F.lag("after").over(session())).where("expected is not null and expected <> before").select("session_id", "sequence", "expected", "before")


def job_reconciliation(jobs: DataFrame, traces: DataFrame) -> DataFrame:
    """Completed jobs without a trace, and traces without a job: job_id, finding."""
    done = jobs.where("status = 'completed'").select("job_id").join(traces, "job_id", "left_anti").select("job_id", F.lit("missing_trace").alias("finding"))
    return done.unionByName(traces.join(jobs.select("job_id"), "job_id", "left_anti").select("job_id", F.lit("extra_trace").alias("finding")))


def rl_steps(trace: DataFrame) -> DataFrame:
    """Steps of training episodes: role, type, masks and the turn reward of the event."""
    role = F.when(is_type("model_response", "tool_requested"), "assistant").when(is_type("tool_finished"), "environment")
    step = F.when(is_type("model_response"), "action").when(is_type("tool_requested"), "action_metadata").when(is_type("tool_finished"), "execution_result")
    mask = is_type("model_response").cast("int")
    rows = trace.where(is_type("model_response", "tool_requested", "tool_finished")).select("session_id", "sequence", "event_id", role.alias("role"), step.alias("step_type"), mask.alias("loss_mask"))
    return rows.join(turn_rewards(trace).select("event_id", "reward"), "event_id", "left").withColumn("reward", F.coalesce("reward", F.lit(0.0)))


def rl_episodes(trace: DataFrame) -> DataFrame:
    """Per episode: steps, assistant actions, and its return with the outcome on the last assistant action (else the last step)."""
    steps = rl_steps(trace).join(outcomes(trace).select("session_id", "success"), "session_id")
    own = steps.groupBy("session_id").agg(
        F.count("*").alias("steps"), F.sum("loss_mask").cast("long").alias("actions"), F.coalesce(F.max(F.when(F.col("loss_mask") == 1, F.col("sequence"))), F.max("sequence")).alias("outcome_sequence"), F.round(F.sum("reward") + F.max(F.col("success").cast("double")), 6).alias("episode_return")
    )
    return own


def action_type(content: Column, calls: Column) -> Column:
    """What an assistant message does; calls: array of tool names."""
    text = F.lower(F.coalesce(content, F.lit("")))
    return (
        F.when((F.size(calls) > 0) & F.forall(calls, lambda c: c == "ask_user"), "ask_user")
        .when(F.size(calls) > 0, "tool_call")
        .when(text.contains("confirm") | text.contains("proceed"), "confirm")
        .when(F.length(F.trim(text)) > 0, "answer")
        .otherwise("stop")
    )


def evaluation_outcomes(results: DataFrame) -> DataFrame:
    """Success (some result, all passed, none an infrastructure failure), reward and count; results: job_id, verifier, passed, infra."""
    fine = F.bool_and("passed") & ~F.bool_or("infra")
    return results.groupBy("job_id").agg(fine.alias("success"), fine.cast("int").alias("reward"), F.count("*").alias("results"), F.bool_or("infra").alias("infrastructure_failure"))


def verifier_metrics(results: DataFrame) -> DataFrame:
    """Per job and verifier the last result, and whether all but agent_termination passed."""
    last = results.groupBy("job_id", "verifier").agg(F.max_by("passed", "position").alias("passed"))
    other = F.when(F.col("verifier") != "agent_termination", F.col("passed"))
    return last.groupBy("job_id").agg(F.count("*").alias("verifiers"), F.count(F.when(F.col("passed"), 1)).alias("passed"), F.coalesce(F.bool_and(other), F.lit(False)).alias("all_non_agent_passed"))


def sft(messages: DataFrame, eligible: DataFrame) -> DataFrame:
    """Training messages of each session in order, as one digest; only sessions of ``eligible`` (session_id) that end with an assistant's words."""
    ordered = F.array_sort(F.collect_list(F.struct("sequence", "role", "content")))
    grouped = messages.join(eligible.select("session_id").distinct(), "session_id", "left_semi").groupBy("session_id").agg(ordered.alias("m"))
    final = F.element_at("m", -1)
    joined = F.array_join(F.transform("m", lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "\n")
    return grouped.where((final["role"] == "assistant") & (F.length(F.trim(final["content"])) > 0)).select("session_id", F.size("m").cast("long").alias("messages"), F.sha2(joined, 256).alias("messages_sha256"))


#: Verifiers whose verdict does not rest on the agent.
HARD_VERIFIERS = ("hidden_command", "required_state", "forbidden_state")


def sft_eligibility(results: DataFrame, replayed: DataFrame) -> DataFrame:
    """job_id and reason ("" if its trace may be trained on), the first that holds of: infrastructure failure,
    not successful, no hard verifier or one without a score, not ended as successful.

    results: job_id, verifier, passed, infra, score; replayed: job_id, success (of the finished trace). A job
    with no replayed trace did not end as successful.
    """
    hard = F.col("verifier").isin(*HARD_VERIFIERS)
    grouped = results.groupBy("job_id").agg(
        F.bool_and("passed").alias("passed"), F.bool_or("infra").alias("infra"), F.count(F.when(hard, 1)).alias("hard"), F.coalesce(F.bool_and(F.when(hard, F.col("score") > 0)), F.lit(False)).alias("scored")
    )
    met = grouped.join(replayed.select("job_id", "success"), "job_id", "left")
    reason = F.when(F.col("infra"), "infrastructure_failure").when(~F.col("passed"), "not_successful").when((F.col("hard") == 0) | ~F.col("scored"), "no_hard_verifier").when(~F.coalesce("success", F.lit(False)), "not_finished_as_successful").otherwise("")
    return met.select("job_id", reason.alias("reason"))


def preference_pairs(runs: DataFrame) -> DataFrame:
    """Per scenario its best and worst run by (reward, trace_id) where their rewards differ."""
    ends = runs.groupBy("scenario_id").agg(F.count("*").alias("runs"), F.max(F.struct("reward", "trace_id")).alias("best"), F.min(F.struct("reward", "trace_id")).alias("worst"))
    return ends.where("best.reward > worst.reward").select("scenario_id", F.col("best.trace_id").alias("chosen"), F.col("worst.trace_id").alias("rejected"), (F.col("best.reward") - F.col("worst.reward")).alias("margin"))


def counts(trace: DataFrame, column: str, of: Column) -> DataFrame:
    return trace.where(of).groupBy(column).agg(F.count("*").alias("n"), F.countDistinct("session_id").alias("sessions"))


def semantic_hash(trace: DataFrame) -> DataFrame:
    """Digest of what happened in a session, without ids and usage; sessions that repeat one another share it."""
    step = F.concat_ws("|", "event_type", F.coalesce("tool", F.lit("")), F.coalesce("tool_status", F.lit("")), F.coalesce("content", F.lit("")))
    return trace.groupBy("session_id").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sequence", step.alias("step")))), lambda x: x["step"]), "\n"), 256).alias("semantic_sha256"))


def prompt_prefixes(messages: DataFrame) -> DataFrame:
    """Before each assistant message: how many messages and characters its prompt has."""
    before = Window.partitionBy("session_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    sizes = messages.select("session_id", "sequence", "role", F.count("*").over(before).alias("prompt_messages"), F.coalesce(F.sum(F.length("content")).over(before), F.lit(0)).cast("long").alias("prompt_chars"))
    return sizes.where("role = 'assistant'").drop("role")
