"""Strict checks of trace events whose payload is JSON: fields, types, hidden names, content ids and order.

Every violation is a row, not only an event's first one. Cases: a payload that is null or no JSON object
has no fields, so that all required ones are missing; an unknown type has no required fields; repeated
rows repeat their violations; an empty table has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.ids import canonical_json, keys_anywhere

VERSION = 2
# Fields that a payload must have, by the event's type.
REQUIRED = {
    "session_started": ("scenario_instance_id", "initial_state_hash"),
    "system_message": ("message_id", "content"),
    "user_message": ("message_id", "content"),
    "model_response": ("message_id", "content"),
    "tool_requested": ("call_id", "name", "arguments"),
    "policy_decision": ("call_id", "decision", "reason"),
    "tool_started": ("call_id", "name"),
    "tool_finished": ("call_id", "status"),
    "tool_message": ("message_id", "name", "tool_call_id", "content"),
    "workspace_diff": ("before_state_hash", "after_state_hash"),
    "verification_result": ("verifier", "passed", "score"),
    "session_finished": ("termination_reason", "final_state_hash", "success"),
}
# Reasons for which a session may end.
TERMINATIONS = ("success", "agent_stop", "user_stop", "policy_violation", "timeout", "token_budget", "tool_budget", "malformed_tool_calls", "infrastructure_failure")
# Names of fields that no public payload may hold.
HIDDEN = (
    "evaluation_payload", "evaluator_payload", "evaluator_state", "forbidden_state", "hidden_command", "hidden_commands", "hidden_user",
    "hidden_evaluator", "hidden_tests", "private_evaluation", "private_evaluator", "reference_answer", "reference_artifacts", "reference_patch",
    "reference_repair", "reference_repairs", "required_state", "rubric", "test_patch", "trace_quality_rubric", "unavailable_facts",
)


def _at(path: str, of: str = "_v") -> Column:
    return F.expr(f"try_variant_get({of}, '$.{path}', 'variant')")


def _quoted(c: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("t"))), r"(?s)^.\"t\":(.*).$", 1)


def _kind(c: Column) -> Column:
    """JSON type of a value; empty if it is missing."""
    return F.coalesce(F.schema_of_variant(c), F.lit(""))


def _is_text(path: str, least: int = 0) -> Column:
    return (_kind(_at(path)) == "STRING") & (F.coalesce(F.length(F.expr(f"try_variant_get(_v, '$.{path}', 'string')")), F.lit(0)) >= least)


def violations(events: DataFrame) -> DataFrame:
    """session_id, sequence and code; events: session_id, sequence, event_type, payload, schema_version, event_id."""
    e = events.select("session_id", "sequence", "event_type", "payload", "schema_version", "event_id").withColumn("_v", F.try_parse_json("payload"))
    e = e.withColumn("_keys", F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>")))
    e = e.withColumn("_calls", F.expr("try_variant_get(_v, '$.tool_calls', 'array<variant>')"))
    kind = F.col("event_type")
    needed = F.create_map(*[x for k, v in REQUIRED.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in sorted(v)]))])
    missing = F.array_except(F.coalesce(F.element_at(needed, kind), F.array().cast("array<string>")), "_keys")
    hidden = F.exists(F.coalesce(keys_anywhere(F.col("payload")), F.array().cast("array<string>")), lambda k: F.translate(F.lower(F.trim(k)), "- ", "__").isin(*HIDDEN))

    def of_call(path: str, c: Column) -> Column:
        return F.try_variant_get(c, path, "variant")

    def filled(path: str) -> Column:
        return F.forall("_calls", lambda c: (_kind(of_call(path, c)) == "STRING") & (F.length(F.try_variant_get(c, path, "string")) > 0))

    ids = F.filter(F.transform("_calls", lambda c: F.try_variant_get(c, "$.id", "string")), lambda x: F.coalesce(x != "", F.lit(False)))
    response, tool = kind == "model_response", kind == "tool_message"
    text = F.concat(F.lit('{"event_type":'), _quoted(kind), F.lit(',"payload":'), F.col("payload"), F.lit(',"schema_version":'), F.col("schema_version").cast("string"), F.lit(',"sequence":'), F.col("sequence").cast("string"), F.lit(',"session_id":'), _quoted(F.col("session_id")), F.lit("}"))
    own = canonical_json(F.when(F.coalesce(F.col("event_id"), F.lit("")) != "", text))
    has_calls = _kind(_at("tool_calls")) != ""

    def on(when: Column, bad: Column, code: str | Column) -> Column:
        return F.when(when & F.coalesce(bad, F.lit(True)), code)

    checks = F.array(
        on(F.lit(True), F.col("schema_version") != VERSION, "unsupported_version"),
        on(F.lit(True), F.col("sequence") < 0, "negative_sequence"),
        on(F.lit(True), ~kind.isin(*REQUIRED), "unknown_event_type"),
        on(F.lit(True), hidden, "hidden_field"),
        on(F.lit(True), F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ","))),
        on(kind.isin("system_message", "model_response", "tool_message") & F.array_contains("_keys", "message_id"), ~_is_text("message_id", 1), "message_id"),
        on((kind == "system_message") & F.array_contains("_keys", "content"), ~_is_text("content", 1), "content"),
        on(response & F.array_contains("_keys", "content"), ~(_is_text("content") | (_kind(_at("content")) == "VOID")), "content"),
        on(tool & F.array_contains("_keys", "content"), ~_is_text("content"), "content"),
        on(tool & F.array_contains("_keys", "tool_call_id"), ~_is_text("tool_call_id", 1), "tool_call_id"),
        on(tool & F.array_contains("_keys", "name"), ~_is_text("name"), "name"),
        on(response & has_calls, F.col("_calls").isNull(), "tool_calls"),
        on(response & F.col("_calls").isNotNull(), ~filled("$.id"), "call_id"),
        on(response & F.col("_calls").isNotNull(), F.size(ids) != F.size(F.array_distinct(ids)), "repeated_call_id"),
        on(response & F.col("_calls").isNotNull(), ~filled("$.function.name"), "function_name"),
        on((kind == "session_finished") & F.array_contains("_keys", "termination_reason"), ~F.expr("try_variant_get(_v, '$.termination_reason', 'string')").isin(*TERMINATIONS), "termination_reason"),
        on(F.coalesce(F.col("event_id"), F.lit("")) != "", F.col("event_id") != F.concat(F.lit("event_"), F.substring(F.sha2(own, 256), 1, 16)), "event_id"),
    )
    return e.select("session_id", "sequence", F.explode(F.array_compact(checks)).alias("code"))


def order_violations(events: DataFrame) -> DataFrame:
    """session_id, sequence and code where a session breaks the order of events and of its tool calls.

    events: session_id, sequence (distinct in a session), event_type, payload.
    """
    e = events.select("session_id", "sequence", "event_type", F.try_parse_json("payload").alias("_v"))
    session = Window.partitionBy("session_id")
    kind = F.col("event_type")
    place = F.row_number().over(session.orderBy("sequence"))
    nth = {k: F.sum((kind == k).cast("int")).over(session.orderBy("sequence")) for k in ("system_message", "session_finished")}
    placed = e.select("session_id", "sequence", "event_type", "_v", place.alias("place"), F.count("*").over(session).alias("n"), nth["system_message"].alias("systems"), nth["session_finished"].alias("ends"))
    shape = F.array_compact(
        F.array(
            F.when((F.col("place") == 1) & (kind != "session_started"), "first_is_not_session_started"),
            F.when((kind == "system_message") & (F.col("systems") > 1), "second_system_message"),
            F.when((F.col("place") == 2) & (kind != "system_message"), "second_is_not_system_message"),
            F.when((kind == "session_finished") & (F.col("ends") > 1), "second_session_finished"),
            F.when((kind == "session_finished") & (F.col("place") != F.col("n")), "session_finished_is_not_last"),
        )
    )
    shaped = placed.select("session_id", "sequence", F.explode(shape).alias("code"))
    calls = e.where(kind == "model_response").select("session_id", "sequence", F.posexplode(F.expr("try_variant_get(_v, '$.tool_calls', 'array<variant>')")).alias("i", "c"))
    calls = calls.select("session_id", "sequence", F.try_variant_get("c", "$.id", "string").alias("call_id"), F.try_variant_get("c", "$.function.name", "string").alias("name"), F.lit(0).alias("answer"), "i")
    answers = e.where(kind == "tool_message").select("session_id", "sequence", F.expr("try_variant_get(_v, '$.tool_call_id', 'string')").alias("call_id"), F.expr("try_variant_get(_v, '$.name', 'string')").alias("name"), F.lit(1).alias("answer"), F.lit(0).alias("i"))
    steps = calls.unionByName(answers).where("call_id is not null")
    before = Window.partitionBy("session_id", "call_id").orderBy("sequence", "i").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("*", F.coalesce(F.sum(1 - F.col("answer")).over(before), F.lit(0)).alias("asked"), F.first(F.when(F.col("answer") == 0, F.col("name")), ignorenulls=True).over(before).alias("asked_name"))
    steps = steps.withColumn("fit", (F.col("answer") == 1) & (F.col("asked") > 0))
    steps = steps.withColumn("done", F.coalesce(F.sum(F.col("fit").cast("int")).over(before), F.lit(0)))
    code = (
        F.when((F.col("answer") == 0) & (F.col("asked") > 0), "repeated_call_id")
        .when((F.col("answer") == 1) & (F.col("asked") == 0), "tool_message_without_call")
        .when((F.col("answer") == 1) & (F.col("done") > 0), "second_tool_message")
        .when((F.col("answer") == 1) & (F.col("name") != F.col("asked_name")), "tool_message_name")
    )
    paired = steps.select("session_id", "sequence", code.alias("code")).where("code is not null")
    change = F.when((F.col("answer") == 0) & (F.col("asked") == 0), 1).when(F.col("fit") & (F.col("done") == 0), -1).otherwise(0)
    changes = steps.groupBy("session_id", "sequence").agg(F.sum(change).alias("change"))
    waiting = e.select("session_id", "sequence", "event_type").join(changes, ["session_id", "sequence"], "left")
    open_before = F.coalesce(F.sum(F.coalesce("change", F.lit(0))).over(session.orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    waiting = waiting.withColumn("open", open_before).where(kind.isin("model_response", "session_finished") & (F.col("open") > 0))
    return shaped.unionByName(paired).unionByName(waiting.select("session_id", "sequence", F.concat(F.lit("open_calls_at_"), kind).alias("code")))
