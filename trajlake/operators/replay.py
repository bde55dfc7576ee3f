"""Observable state of sessions and training episodes, from events whose payload is JSON.

events: session_id, sequence (distinct in a session), event_id, event_type, payload. Each view is one pass of its own kind of
event, without a fold in Python: messages and steps keep an event a row; the state of calls and sessions is an
aggregation whose largest value is one payload field.

Cases: a payload that is null or no JSON has null fields; what the order rules forbid (two starts, a repeated message) is
listed by ``replay_violations`` and still replayed, the last word counting; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.operators.traces import action_type

_ROLES = {"system_message": "system", "user_message": "user", "model_response": "assistant", "tool_message": "tool"}


def _get(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("_v", f"$.{path}", kind)


def _is(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def _read(events: DataFrame) -> DataFrame:
    return events.select("session_id", "sequence", "event_id", "event_type", F.try_parse_json("payload").alias("_v"))


def _last(value: Column, *kinds: str) -> Column:
    """The value of the last event of some kinds."""
    return F.max_by(value, F.when(_is(*kinds), F.col("sequence")))


def _role() -> Column:
    return F.create_map(*[F.lit(x) for p in _ROLES.items() for x in p])[F.col("event_type")]


def messages(events: DataFrame) -> DataFrame:
    """session_id, position (from 0), message_id, role, content, name, tool_call_id, calls and reasoning of every message in order."""
    some = _read(events).where(_is(*_ROLES))
    place = F.row_number().over(Window.partitionBy("session_id").orderBy("sequence")) - 1
    calls = F.when(_is("model_response"), F.coalesce(F.size(_get("tool_calls", "array<variant>")), F.lit(0)))
    own = _is("tool_message")
    return some.select(
        "session_id", place.cast("int").alias("position"), _get("message_id").alias("message_id"), _role().alias("role"), _get("content").alias("content"), F.when(own, _get("name")).alias("name"), F.when(own, _get("tool_call_id")).alias("tool_call_id"), calls.alias("calls"),
        F.when(_is("model_response"), _get("reasoning_content")).alias("reasoning"),
    )


def tool_calls(events: DataFrame) -> DataFrame:
    """Last state of each call: name, arguments, status (requested, started, or what it finished with), decision, exit code, error and the message it gave back."""
    kinds = ("tool_requested", "policy_decision", "tool_started", "tool_finished", "tool_message")
    some = _read(events).where(_is(*kinds)).withColumn("call_id", F.when(_is("tool_message"), _get("tool_call_id")).otherwise(_get("call_id"))).where("call_id is not null")
    status = F.when(_is("tool_requested"), "requested").when(_is("tool_started"), "started").when(_is("tool_finished"), _get("status"))
    asked = F.max_by(_get("name"), F.when(_is("tool_requested"), F.col("sequence")))
    told = F.min_by(_get("name"), F.when(_is("tool_started", "tool_message"), F.col("sequence")))
    return some.groupBy("session_id", "call_id").agg(
        F.coalesce(asked, told).alias("name"), _last(F.to_json(_get("arguments", "variant")), "tool_requested").alias("arguments"), F.max_by(status, F.when(_is("tool_requested", "tool_started", "tool_finished"), F.col("sequence"))).alias("status"),
        _last(_get("decision"), "policy_decision").alias("decision"), _last(_get("reason"), "policy_decision").alias("reason"), _last(_get("exit_code", "long"), "tool_finished").alias("exit_code"), _last(_get("error"), "tool_finished").alias("error"),
        _last(_get("message_id"), "tool_message").alias("message_id"), _last(_get("content"), "tool_message").alias("content"),
    )


def sessions(events: DataFrame) -> DataFrame:
    """One row per session: its instance, the state its workspace ended in, how it ended, and how many events, messages, calls, decisions and verifications it has."""
    some = _read(events)
    state = F.when(_is("session_started"), _get("initial_state_hash")).when(_is("workspace_diff"), _get("after_state_hash")).when(_is("session_finished"), _get("final_state_hash"))

    def n(*kinds: str) -> Column:
        return F.count(F.when(_is(*kinds), 1))

    call = F.when(_is("tool_message"), _get("tool_call_id")).when(_is("tool_requested", "policy_decision", "tool_started", "tool_finished"), _get("call_id"))
    each = some.groupBy("session_id", call.alias("_call")).agg(
        F.count("*").alias("events"), F.max(F.when(_is("session_started"), F.struct("sequence", _get("scenario_instance_id").alias("v")))).alias("begin"), F.max(F.when(state.isNotNull(), F.struct("sequence", state.alias("v")))).alias("state"),
        F.max(F.when(_is("session_finished"), F.struct("sequence", _get("termination_reason").alias("v"), _get("success", "boolean").alias("ok")))).alias("end"),
        n(*_ROLES).alias("messages"), n("policy_decision").alias("decisions"), F.count(F.when(_is("policy_decision") & (_get("decision") != "allow"), 1)).alias("denied"), n("verification_result").alias("verifications"), F.count(F.when(_is("verification_result") & _get("passed", "boolean"), 1)).alias("passed"),
    )
    out = each.groupBy("session_id").agg(F.max("begin").alias("begin"), F.max("state").alias("state"), F.max("end").alias("end"), F.count("_call").alias("tool_calls"), *[F.sum(c).cast("long").alias(c) for c in ("events", "messages", "decisions", "denied", "verifications", "passed")])
    return out.select("session_id", F.col("begin.v").alias("scenario_instance_id"), F.col("state.v").alias("workspace_state_hash"), F.col("end.v").alias("termination_reason"), F.col("end.ok").alias("success"), "events", "messages", "tool_calls", "decisions", "denied", "verifications", "passed")


def replay_violations(events: DataFrame) -> DataFrame:
    """session_id, sequence and code where a replay must stop: a message without an id or with one used before, a state that is not the one left behind."""
    some = _read(events)
    before = Window.partitionBy("session_id", "message_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    said = some.where(_is(*_ROLES)).select("session_id", "sequence", _get("message_id").alias("message_id"))
    bad = said.withColumn("code", F.when(F.coalesce("message_id", F.lit("")) == "", "message_id").when(F.count("*").over(before) > 0, "repeated_message_id"))
    left = F.when(_is("session_started"), _get("initial_state_hash")).when(_is("workspace_diff"), _get("after_state_hash")).otherwise(_get("final_state_hash"))
    met = F.when(_is("workspace_diff"), _get("before_state_hash")).when(_is("session_finished"), _get("final_state_hash"))
    states = some.where(_is("session_started", "workspace_diff", "session_finished")).select("session_id", "sequence", "event_type", left.alias("left"), met.alias("met"))
    known = F.lag("left").over(Window.partitionBy("session_id").orderBy("sequence"))
    states = states.withColumn("known", known).where(F.coalesce(F.col("known") != "", F.lit(False)) & ~_is("session_started") & ~F.col("known").eqNullSafe(F.col("met")))
    return bad.where("code is not null").select("session_id", "sequence", "code").unionByName(states.select("session_id", "sequence", F.concat(F.col("event_type"), F.lit("_state")).alias("code")))


def episode_steps(events: DataFrame, rewards: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Steps of training episodes: session_id, step (from 0), event_id, role, step_type, action_type, content, call_id, name, masks, turn, outcome and reward.

    rewards: event_id (distinct) and reward of turns; outcomes: session_id (distinct) and reward of the whole session. Messages are instructions, observations
    and actions, a requested call the metadata of an action, a finished one its result. The outcome stands on the last assistant action, or the last
    step of a session without one. Sessions without an outcome have none of it.
    """
    kinds = ("system_message", "user_message", "model_response", "tool_requested", "tool_finished", "tool_message")
    some = _read(events).where(_is(*kinds))
    role = F.when(_is("tool_requested"), "assistant").when(_is("tool_finished"), "environment").otherwise(_role())
    kind = F.when(_is("system_message"), "instruction").when(_is("model_response"), "action").when(_is("tool_requested"), "action_metadata").when(_is("tool_finished"), "execution_result").otherwise("observation")
    names = F.transform(F.coalesce(_get("tool_calls", "array<variant>"), F.array().cast("array<variant>")), lambda c: F.coalesce(F.try_variant_get(c, "$.function.name", "string"), F.lit("")))
    action = F.when(_is("model_response"), action_type(_get("content"), names)).when(_is("tool_requested"), _get("name"))
    order = Window.partitionBy("session_id").orderBy("sequence")
    whole = Window.partitionBy("session_id")
    acts = _is("model_response")
    target = F.coalesce(F.max(F.when(acts, F.col("sequence"))).over(whole), F.max("sequence").over(whole))
    content = F.when(_is("tool_finished"), F.coalesce(_get("output"), F.to_json(_get("output", "variant")))).when(~_is("tool_requested"), _get("content"))
    steps = some.select(
        "session_id", (F.row_number().over(order) - 1).cast("int").alias("step"), "event_id", role.alias("role"), kind.alias("step_type"), action.alias("action_type"), content.alias("content"), F.when(_is("tool_message"), _get("tool_call_id")).when(_is("tool_requested", "tool_finished"), _get("call_id")).alias("call_id"),
        F.when(_is("tool_message", "tool_requested"), _get("name")).alias("name"), acts.cast("int").alias("loss_mask"), acts.cast("int").alias("action_mask"), (F.col("sequence") == target).alias("_last"),
    )
    met = steps.join(rewards.select("event_id", F.col("reward").alias("turn")), "event_id", "left").join(outcomes.select("session_id", F.col("reward").cast("double").alias("outcome")), "session_id", "left")
    met = met.withColumns({"turn": F.coalesce("turn", F.lit(0.0)), "outcome": F.when(F.col("_last"), F.coalesce("outcome", F.lit(0.0))).otherwise(0.0)})
    return met.withColumn("reward", F.col("turn") + F.col("outcome")).select("session_id", "step", "event_id", "role", "step_type", "action_type", "content", "call_id", "name", "loss_mask", "action_mask", "turn", "outcome", "reward")
