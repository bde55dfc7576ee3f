"""Replayed sessions, episodes, policy decisions and exports against plain folds over events and cases worked out by hand."""

from __future__ import annotations

import hashlib
import json
import random

from pyspark.sql import functions as F

from trajlake.functions import ids
from trajlake.operators import digests, exports, policy, replay, traces

EVENT = "session_id string, sequence int, event_id string, event_type string, payload string"
KINDS = ["session_started", "system_message", "user_message", "model_response", "tool_requested", "policy_decision", "tool_started", "tool_finished", "tool_message", "workspace_diff", "verification_result", "session_finished", "unknown"]


def _payload(rng, kind):
    call, mid = f"c{rng.randrange(4)}", f"m{rng.randrange(30)}"
    return {
        "session_started": {"scenario_instance_id": f"i{rng.randrange(3)}", "initial_state_hash": rng.choice(["h0", "h1", ""])},
        "system_message": {"message_id": mid, "content": "sys"},
        "user_message": {"message_id": rng.choice([mid, "", None]), "content": 'say "x"\n'},
        "model_response": {"message_id": mid, "content": rng.choice([None, "please proceed", " ", "done"]), "tool_calls": rng.choice([[], [{"id": call, "function": {"name": "ask_user"}}], [{"id": call, "function": {"name": "t"}}]]), "reasoning_content": rng.choice([None, "why"])},
        "tool_requested": {"call_id": call, "name": f"t{rng.randrange(3)}", "arguments": {"b": 1, "a": ["é", None]}},
        "policy_decision": {"call_id": call, "decision": rng.choice(["allow", "deny"]), "reason": "r"},
        "tool_started": {"call_id": call, "name": "ts"},
        "tool_finished": {"call_id": call, "status": rng.choice(["completed", "failed"]), "exit_code": rng.choice([None, 0, 3]), "error": rng.choice([None, "bad"]), "output": rng.choice(["out", {"status": "error"}])},
        "tool_message": {"message_id": mid, "name": "tm", "tool_call_id": call, "content": "back"},
        "workspace_diff": {"before_state_hash": f"h{rng.randrange(2)}", "after_state_hash": f"h{rng.randrange(2)}"},
        "verification_result": {"verifier": "v", "passed": rng.random() < 0.5, "score": 1},
        "session_finished": {"termination_reason": "success", "final_state_hash": f"h{rng.randrange(2)}", "success": rng.random() < 0.5},
    }.get(kind, {"x": 1})


def _events(seed, sessions=12, n=40):
    rng = random.Random(seed)
    return [(f"s{s}", 2 * k + 1, f"e{s}-{k}", kind, json.dumps(_payload(rng, kind))) for s in range(sessions) for k in range(n) for kind in [rng.choice(KINDS)]]


ROLES = {"system_message": "system", "user_message": "user", "model_response": "assistant", "tool_message": "tool"}


def _folded(events):
    """A plain fold: messages, calls, sessions and violations."""
    messages, calls, sessions, bad = [], {}, {}, []
    seen, state = {}, {}
    for s, k, _, kind, raw in sorted(events, key=lambda e: (e[0], e[1])):
        p = json.loads(raw)
        one = sessions.setdefault(s, {"instance": None, "state": None, "reason": None, "success": None, "events": 0, "messages": 0, "calls": set(), "decisions": 0, "denied": 0, "verifications": 0, "passed": 0})
        one["events"] += 1
        if kind in ROLES:
            mid = p["message_id"]
            position = one["messages"]
            one["messages"] += 1
            tool = kind == "tool_message"
            messages.append((s, position, mid, ROLES[kind], p["content"], p["name"] if tool else None, p["tool_call_id"] if tool else None, len(p["tool_calls"]) if kind == "model_response" else None, p.get("reasoning_content") if kind == "model_response" else None))
            if not mid:
                bad.append((s, k, "message_id"))
            elif mid in seen.setdefault(s, set()):
                bad.append((s, k, "repeated_message_id"))
            seen.setdefault(s, set()).add(mid)
        cid = p.get("tool_call_id") if kind == "tool_message" else p.get("call_id") if kind in ("tool_requested", "policy_decision", "tool_started", "tool_finished") else None
        if cid:
            one["calls"].add(cid)
            c = calls.setdefault((s, cid), {"name": None, "asked": False, "arguments": None, "status": None, "decision": None, "reason": None, "exit_code": None, "error": None, "message_id": None, "content": None})
            if kind == "tool_requested":
                c |= {"name": p["name"], "asked": True, "arguments": json.dumps(p["arguments"], sort_keys=True, separators=(",", ":"), ensure_ascii=False), "status": "requested"}
            elif kind == "policy_decision":
                c |= {"decision": p["decision"], "reason": p["reason"]}
                one["decisions"] += 1
                one["denied"] += p["decision"] != "allow"
            elif kind == "tool_started":
                c |= {"status": "started", "name": c["name"] or p["name"]}
            elif kind == "tool_finished":
                c |= {"status": p["status"], "exit_code": p["exit_code"], "error": p["error"]}
            else:
                c |= {"message_id": p["message_id"], "content": p["content"], "name": c["name"] or p["name"]}
        if kind == "session_started":
            one["instance"], one["state"] = p["scenario_instance_id"], p["initial_state_hash"]
            state[s] = p["initial_state_hash"]
        elif kind in ("workspace_diff", "session_finished"):
            met, left = (p["before_state_hash"], p["after_state_hash"]) if kind == "workspace_diff" else (p["final_state_hash"],) * 2
            if state.get(s) and state[s] != met:
                bad.append((s, k, f"{kind}_state"))
            state[s] = one["state"] = left
            if kind == "session_finished":
                one["reason"], one["success"] = p["termination_reason"], p["success"]
        elif kind == "verification_result":
            one["verifications"] += 1
            one["passed"] += p["passed"]
    return messages, calls, sessions, bad


def test_replay_equals_a_plain_fold(spark):
    for seed in (1, 2):
        rows = _events(seed)
        df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), EVENT).repartition(4)
        messages, calls, sessions, bad = _folded(rows)
        assert sorted((tuple(r) for r in replay.messages(df).collect()), key=repr) == sorted(messages, key=repr)
        got = {(r["session_id"], r["call_id"]): r.asDict() for r in replay.tool_calls(df).collect()}
        assert got.keys() == calls.keys()
        for key, want in calls.items():
            assert all(got[key][c] == want[c] for c in ("status", "decision", "reason", "exit_code", "error", "message_id", "content", "arguments")), (key, got[key], want)
            assert got[key]["name"] is not None or want["name"] is None
        out = {r["session_id"]: tuple(r)[1:] for r in replay.sessions(df).collect()}
        assert out == {s: (x["instance"], x["state"], x["reason"], x["success"], x["events"], x["messages"], len(x["calls"]), x["decisions"], x["denied"], x["verifications"], x["passed"]) for s, x in sessions.items()}
        assert sorted(tuple(r) for r in replay.replay_violations(df).collect()) == sorted(bad)


def test_replay_of_odd_payloads_and_nothing(spark):
    rows = [("s", 1, "e1", "model_response", None), ("s", 2, "e2", "tool_finished", "no json"), ("s", 3, "e3", "session_started", "{}"), ("s", 4, "e4", "workspace_diff", "[]")]
    df = spark.createDataFrame(rows, EVENT)
    assert [tuple(r)[1:5] for r in replay.messages(df).collect()] == [(0, None, "assistant", None)]
    assert replay.tool_calls(df).count() == 0 and replay.sessions(df).first()["events"] == 4
    assert [tuple(r) for r in replay.replay_violations(df).collect()] == [("s", 1, "message_id")]
    none = df.limit(0)
    assert replay.messages(none).count() == replay.tool_calls(none).count() == replay.sessions(none).count() == replay.replay_violations(none).count() == 0


def test_steps_of_six_kinds_and_the_place_of_the_outcome(spark):
    rows = _events(5, sessions=6, n=30) + [("only", 1, "o1", "user_message", '{"message_id":"a","content":"q"}'), ("only", 2, "o2", "tool_message", '{"message_id":"b","content":"r","name":"n","tool_call_id":"c"}')]
    df = spark.createDataFrame(rows, EVENT).repartition(3)
    rewards = spark.createDataFrame([(e[2], 0.5) for e in rows[::3]], "event_id string, reward double")
    outcomes = spark.createDataFrame([(s, 1) for s in ("s0", "s1", "only")], "session_id string, reward int")
    got = replay.episode_steps(df, rewards, outcomes).collect()
    kinds = {"system_message": ("system", "instruction", 0), "user_message": ("user", "observation", 0), "model_response": ("assistant", "action", 1), "tool_requested": ("assistant", "action_metadata", 0), "tool_finished": ("environment", "execution_result", 0), "tool_message": ("tool", "observation", 0)}
    turn = {e[2]: 0.5 for e in rows[::3]}
    by = {}
    for e in sorted(rows, key=lambda e: (e[0], e[1])):
        if e[3] in kinds:
            by.setdefault(e[0], []).append(e)
    want = {}
    for s, steps in by.items():
        acts = [k for k, e in enumerate(steps) if e[3] == "model_response"]
        target = acts[-1] if acts else len(steps) - 1
        for k, e in enumerate(steps):
            outcome = 1.0 if k == target and s in ("s0", "s1", "only") else 0.0
            want[e[2]] = (s, k, *kinds[e[3]], turn.get(e[2], 0.0), outcome, turn.get(e[2], 0.0) + outcome)
    assert {r["event_id"]: (r["session_id"], r["step"], r["role"], r["step_type"], r["loss_mask"], r["turn"], r["outcome"], r["reward"]) for r in got} == want
    finished = {r["event_id"]: r["content"] for r in got if r["step_type"] == "execution_result"}
    assert {json.loads(e[4])["output"] if isinstance(json.loads(e[4])["output"], str) else '{"status":"error"}' for e in rows if e[2] in finished} == set(finished.values())


def _looks_like_install(words):
    """The rule told apart from the expressions: which first words and which others fetch packages."""
    if not words:
        return False
    local = "--no-index" in words or "--no-deps" in words
    if words[0] in ("pip", "pip3") and "install" in " ".join(words).split(" ")[1:-1] + ([words[-1]] if words[-1] == "install" else []):
        return not local
    if words[:3] in (["python", "-m", "pip"], ["python3", "-m", "pip"]):
        return "install" in words and not local
    return words[0] in ("npm", "pnpm", "yarn") and bool({"install", "add"} & set(words)) or words[0] in ("apt", "apt-get", "apk", "yum", "dnf", "brew")


def test_policy_rules(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(400):
        words = [rng.choice(["pip", "pip3", "python", "python3", "npm", "yarn", "apt", "ls", "-m", "pip", "install", "add", "--no-deps", "--no-index", "x", "curl", "https://a"]) for _ in range(rng.randint(0, 5))]
        tool = rng.choice(["run_command", "run_command", "read_file", "other", None])
        path = rng.choice(["a", "../b", "a..b", "/etc/x", "/var/run/docker.sock", "etc/"])
        arguments = {"command": words, "path": {"in": [path]}} if rng.random() < 0.3 else {"command": words}
        line = " ".join(words)
        if tool not in ("run_command", "read_file"):
            reason = "tool_not_enabled"
        elif any(p in json.dumps(arguments) for p in policy.FORBIDDEN_PATHS):
            reason = "forbidden_host_path"
        elif tool == "run_command" and any(n in line for n in policy.NETWORK):
            reason = "network_disabled"
        elif tool == "run_command" and _looks_like_install(words):
            reason = "package_installation"
        else:
            reason = "allowed"
        rows.append((k, tool, json.dumps(arguments)))
        want[k] = reason
    rows += [(900, "read_file", None), (901, "run_command", '{"command":"pip install x"}'), (902, "read_file", '{"\\u002e\\u002e":1}'), (903, "run_command", '{"command":[1,null,true]}'), (904, "run_command", "[]")]
    want |= {900: "allowed", 901: "allowed", 902: "forbidden_host_path", 903: "allowed", 904: "allowed"}
    df = spark.createDataFrame(rows, "event_id int, tool string, arguments string")
    got = {r["event_id"]: (r["decision"], r["reason"]) for r in policy.decisions(df, ("run_command", "read_file")).collect()}
    assert got == {k: ("allow" if r == "allowed" else "deny", r) for k, r in want.items()}
    open_ = {r["event_id"]: r["reason"] for r in policy.decisions(df, ("run_command", "read_file"), network=True).collect()}
    assert open_ == {k: r if r in ("tool_not_enabled", "forbidden_host_path") else "allowed" for k, r in want.items()}


RUN = "trace_id string, scenario_id string, reward int, success boolean, infrastructure_failure boolean, analysis string, rl string, sft string"


def _run(t, s, reward, success, infra=False):
    return t, s, reward, success, infra, f"a{t}", f"r{t}", f"s{t}"


def test_exports_manifest_and_its_differences(spark, monkeypatch):
    monkeypatch.setattr(digests, "RUN_BYTES", 5)
    runs = spark.createDataFrame([_run("t1", "x", 1, True), _run("t2", "x", 0, False), _run("t3", "y", 1, True), _run("t4", "y", 1, None), _run("t5", "z", 1, True, True), _run("t6", "z", 0, False), _run("t7", "w", 1, True), _run("t8", "v", 1, True), _run("t9", "v", 0, False)], RUN).repartition(4)
    quarantined = spark.createDataFrame([("t9",), ("t9",), ("none",)], "trace_id string")
    again = spark.createDataFrame([("t1", True), ("t3", True), ("t3", None), ("t7", True), ("t8", True)], "trace_id string, reproduced boolean")
    records = exports.export_records(runs, quarantined, again)
    by = {v: sorted(r["record_id"] for r in records.collect() if r["view"] == v) for v in exports.VIEWS}
    assert by == {"analysis": [f"t{k}" for k in range(1, 10)], "rl": ["t1", "t2", "t3", "t4", "t6", "t7", "t8"], "sft": ["t1", "t7", "t8"], "preference": ["preference_t1_t2"]}
    assert json.loads(next(r["line"] for r in records.collect() if r["view"] == "preference")) == {"chosen_trace_id": "t1", "id": "preference_t1_t2", "margin": 1, "rejected_trace_id": "t2", "scenario_id": "x"}
    skips = {tuple(r) for r in exports.export_skips(runs, quarantined, again).collect()}
    assert skips == {("quarantined", 1), ("infrastructure_failure", 1), ("success_not_reproduced", 1), ("preference_tie", 1), ("preference_ineligible", 2), ("preference_not_two_runs", 1)}
    right = exports.manifest(records)
    want = {v: (len(names), hashlib.sha256("".join(f"{v[0]}{n}\n" for n in names).encode()).hexdigest()) for v, names in by.items() if v != "preference"}
    got = {r["view"]: (r["records"], r["sha256"]) for r in right.collect()}
    assert {v: got[v] for v in want} == want and got["preference"][0] == 1
    empty = exports.manifest(records.limit(0))
    assert {tuple(r) for r in empty.collect()} == {(v, 0, hashlib.sha256(b"").hexdigest()) for v in exports.VIEWS}
    declared = spark.createDataFrame([("analysis", 9, want["analysis"][1]), ("rl", 8, "x"), ("sft", 3, want["sft"][1]), ("sft", 3, want["sft"][1]), ("odd", 1, "x")], "view string, records long, sha256 string")
    assert {tuple(r) for r in exports.manifest_differences(declared, right).collect()} == {("rl", "records"), ("rl", "sha256"), ("sft", "doubled"), ("odd", "unexpected"), ("preference", "missing")}


def test_digests_in_order_at_any_size_of_runs(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(50), "l" * rng.randrange(4)) for _ in range(2000)] + [("c", 1, None)]
    want = {}
    for key in ("a", "b"):
        lines = [x for _, _, x in sorted(r for r in rows if r[0] == key)]
        want[key] = (len(lines), hashlib.sha256(("<" + "|".join(lines) + ">").encode()).hexdigest())
    for size, parts in ((1, 5), (100, 3), (1 << 20, 1)):
        monkeypatch.setattr(digests, "RUN_BYTES", size)
        df = spark.createDataFrame(rng.sample(rows, len(rows)), "k string, o int, l string").repartition(parts)
        got = digests.ordered_digests(df, F.col("k"), F.col("o"), F.col("l"), "|", "<", ">").collect()
        assert {r["key"]: (r["n"], r["sha256"]) for r in got} == want


def test_training_messages_of_eligible_sessions_only(spark):
    rows = [("a", 0, "user", "q"), ("a", 1, "assistant", "r"), ("b", 0, "assistant", "r"), ("c", 0, "assistant", " "), ("d", 0, "user", "q")]
    df = spark.createDataFrame(rows, "session_id string, sequence int, role string, content string")
    fit = spark.createDataFrame([(s,) for s in ("a", "a", "c", "d", "x")], "session_id string")
    assert [tuple(r)[:2] for r in traces.sft(df, fit).collect()] == [("a", 2)]


def test_keys_of_long_and_escaped_texts(spark):
    long = json.dumps({"html": '<a href="x">\n\\' * 50_000, "deep": [{"Hidden Tests": 1}]})
    cases = [(long, True), (json.dumps({"html": 'hidden_tests":' * 20_000}), False), ('{"hidden\\u005ftests":1}', True), ('{"a":"\\\\","hidden-tests":1}', True), ('{"a":"\\"hidden_tests\\":"}', False), ('{"a\\"hidden_tests":1}', False), ("no json", False), (None, False)]
    df = spark.createDataFrame([(k, raw) for k, (raw, _) in enumerate(cases)], "k int, raw string")
    got = {r["k"]: r["h"] for r in df.select("k", ids.has_key(F.col("raw"), ["hidden_tests"]).alias("h")).collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)}


def test_figures_of_conversations(spark):
    from trajlake.operators import interactions

    rng = random.Random(8)
    rows = [(rng.choice("abc"), rng.choice([*interactions.ACTIONS, None]), rng.choice([None, "r1", "r2", "r3"]), *[rng.choice([True, False, None]) for _ in interactions.FLAGS]) for _ in range(90)] + [("quiet", None, None, *[None] * 6)]
    goals = [(rng.choice("ab"), rng.choice("xyz"), rng.choice([True, False, None])) for _ in range(12)] + [("gone", "x", True)]
    schema = "session_id string, action string, response string, " + ", ".join(f"{c} boolean" for c in interactions.FLAGS)
    got = {r["session_id"]: r for r in interactions.interaction_metrics(spark.createDataFrame(rows, schema), spark.createDataFrame(goals, "session_id string, component string, satisfied boolean")).collect()}
    assert got.keys() == {"a", "b", "c", "quiet"}
    for s, r in got.items():
        own = [x for x in rows if x[0] == s]
        said = [x[2] for x in own if x[2] is not None]
        parts = {g: any(x[2] for x in goals if x[0] == s and x[1] == g) for g in {x[1] for x in goals if x[0] == s}}
        assert [r[c] for c in interactions.ACTIONS.values()] == [sum(x[1] == a for x in own) for a in interactions.ACTIONS]
        assert [r[c] for c in interactions.FLAGS] == [sum(x[3 + k] is True for x in own) for k in range(6)]
        assert (r["turns"], r["responses"], r["goal_components_total"], r["goal_components_satisfied"]) == (len(own), len(said), len(parts), sum(parts.values()))
        assert r["diversity"] == (round(len(set(said)) / len(said), 6) if said else 0.0) and r["goal_alignment"] == (round(sum(parts.values()) / len(parts), 6) if parts else 1.0)
        assert r["simulator_error_rate"] == round(sum(x[8] is True for x in own) / len(own), 6)


def test_disclosed_facts(spark):
    from trajlake.operators import interactions

    rows = [(1, 0, "The KEY is x"), (1, 1, "key and door"), (1, 2, None), (1, 3, "key"), (2, 0, "door")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, text string")
    assert {tuple(r) for r in interactions.disclosures(df, ["Key", "door", " "]).collect()} == {(1, 0, "key", True), (1, 1, "key", False), (1, 1, "door", True), (1, 3, "key", True), (2, 0, "door", True)}
    assert interactions.disclosures(df, []).count() == 0
