"""Strict checks of dynamic records against cases worked out by hand."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from trajlake.functions import fields
from trajlake.operators import events, records, traces, usage

EVENT = "session_id string, sequence int, event_type string, payload string, schema_version int, event_id string"


def _event(session, sequence, kind, payload, version=2, event_id=""):
    return session, sequence, kind, payload if payload is None or isinstance(payload, str) else json.dumps(payload), version, event_id


def _codes(spark, rows, check=events.violations):
    return {(r["sequence"], r["code"]) for r in check(spark.createDataFrame(rows, EVENT)).collect()}


def test_event_fields(spark):
    payload = '{"content":"c","message_id":"m"}'
    own = f'{{"event_type":"user_message","payload":{payload},"schema_version":2,"sequence":1,"session_id":"s"}}'
    good = "event_" + hashlib.sha256(own.encode()).hexdigest()[:16]
    call = {"id": "c", "function": {"name": "f"}}
    rows = [
        _event("s", 1, "user_message", payload, event_id=good),
        _event("s", 2, "user_message", payload, event_id="event_x"),
        _event("s", -3, "user_message", payload, version=1),
        _event("s", 4, "tool_requested", {"name": "x"}),
        _event("s", 5, "odd", {}),
        _event("s", 6, "user_message", '{"content":"c","message_id":"m","x":[{"hidden\\u005ftests":1}]}'),
        _event("s", 7, "user_message", {"content": 'say "rubric": no', "message_id": "m"}),
        _event("s", 8, "model_response", {"message_id": "", "content": None, "tool_calls": [call, call, {"id": "", "function": 1}]}),
        _event("s", 9, "model_response", {"message_id": "m", "content": 4, "tool_calls": {}}),
        _event("s", 10, "session_finished", {"termination_reason": "tired", "final_state_hash": "x", "success": True}),
        _event("s", 11, "tool_message", {"message_id": "m", "name": 3, "tool_call_id": "", "content": None}),
        _event("s", 12, "system_message", None),
    ]
    assert _codes(spark, rows) == {
        (2, "event_id"), (-3, "unsupported_version"), (-3, "negative_sequence"), (4, "missing:arguments,call_id"), (5, "unknown_event_type"), (6, "hidden_field"),
        (8, "message_id"), (8, "repeated_call_id"), (8, "call_id"), (8, "function_name"), (9, "content"), (9, "tool_calls"), (10, "termination_reason"),
        (11, "name"), (11, "tool_call_id"), (11, "content"), (12, "missing:content,message_id"),
    }
    assert not _codes(spark, rows[:0])


def test_event_order(spark):
    def response(session, n, *ids):
        return _event(session, n, "model_response", {"tool_calls": [{"id": i, "function": {"name": "f" + i}} for i in ids]})

    def tool(session, n, i, name=None):
        return _event(session, n, "tool_message", {"tool_call_id": i, "name": name or "f" + i})

    fine = [_event("a", 0, "session_started", {}), _event("a", 1, "system_message", {}), response("a", 2, "x", "y"), tool("a", 3, "y"), tool("a", 4, "x"), response("a", 5), _event("a", 6, "session_finished", {})]
    assert not _codes(spark, fine, events.order_violations)
    bad = [
        _event("b", 0, "user_message", {}), response("b", 1, "x", "y"), tool("b", 2, "x", "other"), tool("b", 3, "x"), tool("b", 4, "z"), response("b", 5, "x"),
        _event("b", 6, "system_message", {}), _event("b", 7, "system_message", {}), _event("b", 8, "session_finished", {}), _event("b", 9, "session_finished", {}),
    ]
    assert _codes(spark, bad, events.order_violations) == {
        (0, "first_is_not_session_started"), (1, "second_is_not_system_message"), (2, "tool_message_name"), (3, "second_tool_message"), (4, "tool_message_without_call"), (5, "repeated_call_id"),
        (5, "open_calls_at_model_response"), (7, "second_system_message"), (8, "session_finished_is_not_last"), (8, "open_calls_at_session_finished"), (9, "second_session_finished"), (9, "open_calls_at_session_finished"),
    }


def test_pricing_cases(spark):
    rows = [
        ({"prompt_tokens": 1000, "completion_tokens": 500, "prompt_tokens_details": {"cached_tokens": 200}}, ("2", "0.5", "6"), (1000, 200, 500, 0.0047, "")),
        ({"prompt_cache_hit_tokens": 400, "prompt_cache_miss_tokens": 600, "completion_tokens": 100}, ("1", "0.1", "2"), (1000, 400, 100, 0.00084, "")),
        ({"prompt_tokens": 100, "completion_tokens": 20, "total_tokens": 999}, ("1", "0.1", "2"), (None, None, None, None, "total")),
        ({"input_tokens": 10, "prompt_tokens": 11, "completion_tokens": 1}, ("1", "0.1", "2"), (None, None, None, None, "input_conflict")),
        ({"input_tokens": True, "output_tokens": 1}, ("1", "0.1", "2"), (None, None, None, None, "not_a_count")),
        ({"input_tokens": 5, "output_tokens": -1}, ("1", "0.1", "2"), (None, None, None, None, "not_a_count")),
        ({}, ("1", "0.1", "2"), (None, None, None, None, "empty")),
        ({"input_tokens": 5, "output_tokens": 1, "input_tokens_details": {"cached_tokens": 6}}, ("1", "0.1", "2"), (None, None, None, None, "cached_above_input")),
    ]
    for record, prices, want in rows:
        r = usage.priced(spark.createDataFrame([(json.dumps(record),)], "raw string"), "raw", *prices).first()
        assert (r["input_tokens"], r["cached_tokens"], r["output_tokens"], None if r["cost_usd"] is None else float(r["cost_usd"]), r["error"]) == want


def test_fields(spark):
    rows = spark.createDataFrame([("a, b,,a",), (None,), ('["x", 1, null, true, " "]',), ("[broken",)], "f string")
    assert [r[0] for r in rows.select(fields.list_field(F.col("f"))).collect()] == [["a", "b", "a"], [], ["x", "1", "True"], None]
    times = spark.createDataFrame([("2024-03-01T01:00:00+02:00",), ("2024-03-01T01:00:00.5Z",), ("2024-03-01T01:00:00",), ("2024-13-01T01:00:00Z",), ("no",), (None,)], "t string")
    assert [r[0] for r in times.select(fields.canonical_timestamp(F.col("t"))).collect()] == ["2024-02-29T23:00:00Z", "2024-03-01T01:00:00.500000Z", None, None, None, None]
    sizes = spark.createDataFrame([("512m",), (" 1.5G ",), ("12",), ("",), ("xk",), (None,)], "s string")
    assert [r[0] for r in sizes.select(fields.memory_bytes(F.col("s"))).collect()] == [512 << 20, 3 << 29, -1, -1, -1, -1]
    maps = spark.createDataFrame([({"API-Key": "1", "path": "2", "my_TOKEN": "3"},)], "m map<string,string>")
    assert maps.select(fields.secret_keys(F.col("m"))).first()[0] == ["API-Key", "my_TOKEN"]
    licences = spark.createDataFrame([("Apache 2.0",), ("0BSD",), ("python-2.0",), ("GPL-3.0",), ("",), (None,)], "l string")
    assert [r[0] for r in licences.select(records.license_ok(F.col("l"))).collect()] == [True, True, True, False, False, False]


def test_sft_needs_a_hard_verifier(spark):
    results = spark.createDataFrame([("a", "hidden_command", True, False, 1.0), ("b", "agent_termination", True, False, 1.0), ("c", "hidden_command", True, False, 0.0), ("d", "hidden_command", False, False, 0.0), ("e", "hidden_command", True, True, 1.0), ("f", "required_state", True, False, 1.0)], "job_id string, verifier string, passed boolean, infra boolean, score double")
    replayed = spark.createDataFrame([(j, True) for j in "abcde"], "job_id string, success boolean")
    got = {r["job_id"]: r["reason"] for r in traces.sft_eligibility(results, replayed).collect()}
    assert got == {"a": "", "b": "no_hard_verifier", "c": "no_hard_verifier", "d": "not_successful", "e": "infrastructure_failure", "f": "not_finished_as_successful"}


def test_selections(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "job_id string")
    some = rows.where("job_id <> 'a'")
    assert records.selected_ids(rows, "job_id").count() == 3 and records.selected_ids(rows, "job_id", some.where("false")).count() == 0
    assert [r[0] for r in records.selected_ids(rows, "job_id", some, rows.where("job_id <> 'b'")).collect()] == ["c"]
    assert records.job_selection(rows.where("false"), rows.where("false")) is None and records.job_selection(some, rows).count() == 3
