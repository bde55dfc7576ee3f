"""Cross-artifact checks, strict reports and content ids against cases worked out by hand and plain loops."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from trajlake.functions import typed
from trajlake.operators import artifacts, events

CALL = "job_id string, position int, call_index int, status string, model string, response_model string, response_id string, response_object string, identity_model string, input_tokens long, output_tokens long, total_tokens long, prompt_hash string, started_at string, message_count int, tool_count int, temperature double, prompt_token_upper_bound long, max_tokens long, retry_count int, latency_ms double"
SAID = "job_id string, sequence int, trace_model string, trace_input long, trace_output long, trace_total long"
CONTRACT = artifacts.Contract("m", ("m-b",), 0.2, 50, 200)


def _call(job, n, **changes):
    one = {"job_id": job, "position": n, "call_index": n, "status": "completed", "model": "m", "response_model": "m", "response_id": f"{job}{n}", "response_object": "chat.completion", "identity_model": "m", "input_tokens": 30, "output_tokens": 20, "total_tokens": 50, "prompt_hash": "a" * 64, "started_at": "t", "message_count": 1, "tool_count": 0, "temperature": 0.2, "prompt_token_upper_bound": 40, "max_tokens": min(50, 160 - 50 * n), "retry_count": 0, "latency_ms": 1.5}
    return tuple({**one, **changes}.values())


def _said(job, n, model="m", i=30, o=20, total=50):
    return job, 10 * n + 1, model, i, o, total


def _violations(spark, calls, said):
    a, b = spark.createDataFrame(calls, CALL), spark.createDataFrame(said, SAID)
    return {(r["job_id"], r["place"], r["code"]) for r in artifacts.call_violations(a.repartition(3), b.repartition(2), CONTRACT).collect()}


def test_calls_in_order_and_within_budget(spark):
    assert not _violations(spark, [_call("a", n) for n in range(3)], [_said("a", n) for n in range(3)])
    assert not _violations(spark, [], [])
    # a call that spends more than it may: the next ones are measured by what was spent
    calls = [_call("a", 0), _call("a", 1, output_tokens=70, total_tokens=100), _call("a", 2, max_tokens=10), _call("a", 3, max_tokens=10, prompt_token_upper_bound=31)]
    said = [_said("a", 0), _said("a", 1, o=70, total=100), _said("a", 2, o=9, total=39), _said("a", 3)]
    calls[2] = _call("a", 2, max_tokens=10, output_tokens=9, total_tokens=39)
    assert _violations(spark, calls, said) == {("a", 1, "output_beyond_max_tokens"), ("a", 3, "call_beyond_budget"), ("a", 3, "job_beyond_budget")}


@pytest.mark.parametrize(
    ("changes", "codes"),
    [
        ({"call_index": 1}, {"call_index"}), ({"status": None}, {"status"}), ({"model": "m-b"}, {"request_model"}), ({"response_model": "x", "identity_model": "x"}, {"response_model", "trace_model"}),
        ({"response_id": " "}, {"response_id"}), ({"response_object": None}, {"response_object"}), ({"identity_model": "m-b"}, {"identity_model"}), ({"total_tokens": 51}, {"usage"}), ({"output_tokens": None}, {"usage"}),
        ({"prompt_hash": "A" * 64}, {"prompt_hash"}), ({"started_at": ""}, {"started_at"}), ({"message_count": -1}, {"message_count"}), ({"tool_count": None}, {"tool_count"}), ({"temperature": 0.3}, {"temperature"}),
        ({"prompt_token_upper_bound": 0}, {"prompt_token_upper_bound", "input_beyond_bound"}), ({"prompt_token_upper_bound": 29}, {"input_beyond_bound"}), ({"max_tokens": 49}, {"max_tokens"}),
        ({"retry_count": -2}, {"retry_count"}), ({"latency_ms": float("nan")}, {"latency_ms"}), ({"latency_ms": float("inf")}, {"latency_ms"}), ({"prompt_token_upper_bound": None}, {"prompt_token_upper_bound", "max_tokens"} - {"max_tokens"}),
    ],
)
def test_each_mismatch_has_its_code(spark, changes, codes):
    assert _violations(spark, [_call("a", 0, **changes)], [_said("a", 0)]) == {("a", 0, c) for c in codes}


def test_sides_of_unequal_length_and_repeated_ids(spark):
    got = _violations(spark, [_call("a", 0), _call("a", 1, response_id="a0"), _call("b", 0)], [_said("a", 0), _said("a", 1), _said("a", 2), _said("c", 0)])
    assert got == {("a", 1, "repeated_response_id"), ("a", 2, "response_without_call"), ("b", 0, "call_without_response"), ("c", 0, "response_without_call")}


def test_budgets_equal_a_plain_loop(spark):
    rng = random.Random(6)
    calls, said, want = [], [], {}
    for job in map(str, range(60)):
        spent = 0
        for n in range(rng.randint(1, 9)):
            bound, total = rng.randint(1, 60), rng.randint(0, 60)
            calls.append(_call(job, n, prompt_token_upper_bound=bound))
            said.append(_said(job, n, total=total))
            want[job, n] = spent, min(50, 200 - spent - bound)
            spent += total
    rng.shuffle(calls)
    for parts in (1, 7):
        got = artifacts.call_budgets(spark.createDataFrame(calls, CALL).repartition(parts), spark.createDataFrame(said, SAID).repartition(parts), CONTRACT).collect()
        assert {(r["job_id"], r["place"]): (r["spent"], r["allowed"]) for r in got} == want


def _sets(spark, assignments=(), rows=(), traces=(), reports=(), evidence=()):
    one, two = "job_id string", "job_id string, trace_id string"
    made = [spark.createDataFrame(list(x), t) for x, t in ((assignments, one), (rows, "job_id string, status string, trace_id string"), (traces, two), (reports, two), (evidence, one))]
    return {r["job_id"]: (set(r["codes"]), r["complete"]) for r in artifacts.artifact_sets(*made).collect()}


def test_missing_extra_and_doubled_artifacts(spark):
    fine = {"assignments": [("a",)], "rows": [("a", "completed", "t")], "traces": [("a", "t")], "reports": [("a", "t")], "evidence": [("a",)]}
    assert _sets(spark, **fine) == {"a": (set(), True)} and _sets(spark) == {}

    def codes(**changes):
        return _sets(spark, **{**fine, **changes})

    assert codes(traces=[])["a"] == ({"missing_trace"}, False)
    assert codes(reports=[], evidence=[])["a"][0] == {"missing_report", "missing_evidence"}
    assert codes(rows=[])["a"][0] == {"missing_row", "trace_without_completed_row", "report_without_completed_row", "evidence_without_completed_row"}
    assert codes(rows=[("a", None, "t")])["a"][0] == {"not_completed", "trace_without_completed_row", "report_without_completed_row", "evidence_without_completed_row"}
    assert codes(traces=[("a", "t"), ("a", "t")])["a"] == ({"double_trace"}, False)
    assert codes(assignments=[])["a"][0] == {f"{s}_outside_contract" for s in artifacts.SIDES[1:]}
    assert codes(rows=[("a", "completed", None)])["a"][0] == {"trace_id_of_row"} and codes(reports=[("a", "u")])["a"][0] == {"trace_id_of_report"}
    assert codes(evidence=[("a",), (" ",), (None,)])[""] == ({"blank_evidence"}, False)


def test_response_ids_of_several_calls(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", " "), ("c", None), ("d", " ")], "job_id string, response_id string")
    assert [tuple(r) for r in artifacts.shared_response_ids(df).collect()] == [("x", 3, 2)]


EVIDENCE = {"evaluator": "e", "passed": True, "score": 0.5, "reason": "r"}
TURN = {"turn_index": 0, "event_id": "e", "kind": "k", "action_type": "a", "reward": 1.0, "reason": "", "evidence": {}}
REPORT = {"scenario_instance_id": "s", "success": True, "reward": 1, "infrastructure_failure": False, "results": [EVIDENCE], "metrics": {"a": 1, "b": 2.5}, "turn_rewards": [TURN]}


def test_strict_reports(spark):
    def with_(**changes):
        return json.dumps({**REPORT, **changes})

    def without(*names):
        return json.dumps({k: v for k, v in REPORT.items() if k not in names})

    cases = [
        (json.dumps(REPORT), ""), (without("metrics", "turn_rewards"), ""), (with_(reward=10**25), ""), (with_(reward=-4, more={"x": [None, 1]}), ""),
        (with_(success=1), "$.success:boolean"), (with_(reward=True), "$.reward:whole"), (with_(reward=1.0), "$.reward:whole"), (with_(reward="1"), "$.reward:whole"), (with_(reward=1e30), "$.reward:whole"),
        (with_(scenario_instance_id=None), "$.scenario_instance_id:text"), (without("success"), "$.success:boolean"), (with_(metrics=None), "$.metrics:object"), (with_(metrics={"b": "1", "a": True}), "$.metrics.a:number"),
        (with_(results={}), "$.results:list"), (with_(results=[3]), "$.results[0]:object"), (with_(results=[EVIDENCE, {**EVIDENCE, "score": True}]), "$.results[1].score:number"), (with_(results=[{**EVIDENCE, "evidence": []}]), "$.results[0].evidence:object"),
        (with_(results=[{**EVIDENCE, "infrastructure_failure": 0}]), "$.results[0].infrastructure_failure:boolean"), (with_(turn_rewards=[{**TURN, "turn_index": -1}]), "$.turn_rewards[0].turn_index:at_least_0"), (with_(turn_rewards=[TURN, {**TURN, "reward": None}]), "$.turn_rewards[1].reward:number"),
        (json.dumps(REPORT).replace("0.5", "NaN"), "$:json"), (json.dumps(REPORT).replace("0.5", "1e999"), "$.results[0].score:number"), ('{"a":1,"a":2}', "$:json"), ("", "$:json"), (None, "$:json"), ("[]", "$:object"), ("3", "$:object"), ("null", "$:object"),
    ]
    df = spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(cases)], "k int, raw string")
    got = {r["k"]: r["fault"] for r in df.select("k", typed.first_fault(F.col("raw"), typed.REPORT).alias("fault")).collect()}
    assert [got[k] for k in range(len(cases))] == [want for _, want in cases]


def test_event_ids_do_not_depend_on_spelling(spark):
    value = {"content": 'a "b" \\ é   😀', "message_id": "m", "n": 1.5, "z": {"b": 1, "a": [True, None]}}

    def own(session, kind, payload):
        text = json.dumps({"schema_version": 2, "session_id": session, "sequence": 1, "event_type": kind, "payload": payload}, sort_keys=True, separators=(",", ":"))
        return "event_" + hashlib.sha256(text.encode()).hexdigest()[:16]

    spelled = [json.dumps(value), json.dumps(value, ensure_ascii=False, indent=2), json.dumps(dict(reversed(value.items()))), json.dumps(value, separators=(",", ":"))]
    rows = [(s, 1, "user_message", raw, 2, own(s, "user_message", value)) for raw in spelled for s in ("s", 's"1', "s\\é\n")]
    df = spark.createDataFrame(rows, "session_id string, sequence int, event_type string, payload string, schema_version int, event_id string")
    assert events.violations(df).collect() == []
    wrong = spark.createDataFrame([("s", 1, "user_message", spelled[0], 2, own("t", "user_message", value)), (None, 1, "user_message", spelled[0], 2, "event_1")], df.schema)
    assert [r["code"] for r in events.violations(wrong).collect()] == ["event_id", "event_id"]


def test_calls_are_dealt_once_and_null_jobs_match_nothing(spark):
    calls = spark.createDataFrame([(None, 0), ("a", 5)], "job_id string, position int")
    missing = {c.split()[0]: c.split()[1] for c in CALL.split(", ") if c.split()[0] not in ("job_id", "position")}
    calls = calls.select("*", *[F.lit(None).cast(t).alias(c) for c, t in missing.items()])
    said = spark.createDataFrame([(None, 1), ("a", 7), ("a", 8)], "job_id string, sequence int")
    missing = {c.split()[0]: c.split()[1] for c in SAID.split(", ") if c.split()[0] not in ("job_id", "sequence")}
    said = said.select("*", *[F.lit(None).cast(t).alias(c) for c, t in missing.items()])
    found = artifacts.call_violations(calls, said, CONTRACT)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    alone = {(r["job_id"], r["place"], r["code"]) for r in found.collect() if r["code"].endswith(("_call", "_response"))}
    assert alone == {(None, 0, "call_without_response"), (None, 0, "response_without_call"), ("a", 1, "response_without_call")}
