"""Folder trees, crash recovery, curated records, admission and test commands against plain loops and cases worked out by hand."""

from __future__ import annotations

import datetime
import hashlib
import json
import os
import pathlib
import random
import shlex

import pytest
from pyspark.sql import functions as F

from trajlake.functions import commands
from trajlake.operators import curation, digests, jobs, recovery, trees

# --- trees


def _tree(entries):
    """The definition: entries outside .git in order of their path's parts."""
    some = sorted({p: (k, s, t) for p, k, s, t in reversed(entries) if p != ".git" and not p.startswith(".git/")}.items(), key=lambda e: e[0].split("/"))
    own = [{"path": p, "type": k, **({"sha256": s} if k == "file" else {"target": t} if k == "symlink" else {})} for p, (k, s, t) in some]
    return len(own), hashlib.sha256(json.dumps(own, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _hashes(spark, rows, parts=5):
    df = spark.createDataFrame(rows, "tree_id string, path string, kind string, sha256 string, target string").repartition(parts)
    return {r["tree_id"]: (r["entries"], r["tree_sha256"]) for r in trees.tree_hashes(df).collect()}


def test_tree_hash_by_definition(spark, monkeypatch):
    monkeypatch.setattr(digests, "RUN_BYTES", 60)
    names = ["a", "a-b", "a/b", "a.b/c", "é/ü", 'q"uo\\te', ".git", ".git/x", ".gitignore", ".github/w", "sub/.git/kept", "z\n", "日/😀"]
    entries = [(n, ["file", "symlink", "dir"][k % 3], f"{k:064x}", f"../t{k}") for k, n in enumerate(names)]
    more = [(f"d{k % 7}/f{k}", "file", f"{k:064x}", None) for k in range(300)]
    rows = [("one", *e) for e in entries] + [("two", *e) for e in more] + [("one", *entries[1]), (None, *entries[0]), ("one", None, "file", "x", None), ("one", "pipe", "fifo", None, None), ("none", ".git", "dir", None, None)]
    want = {"one": _tree(entries), "two": _tree(more)}
    for parts in (1, 6):
        random.Random(parts).shuffle(rows)
        assert _hashes(spark, rows, parts) == want
    assert _hashes(spark, []) == {}


def test_a_folder_on_disk(spark, tmp_path):
    for name in ("a/b/c.txt", "a-b.txt", "a/b.txt", ".git/config", "deep/x/y/z"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(os.urandom(20))
    entries = []
    for p in sorted(pathlib.Path(tmp_path).rglob("*")):
        rel = p.relative_to(tmp_path).as_posix()
        entries.append((rel, "dir", None, None) if p.is_dir() else (rel, "file", hashlib.sha256(p.read_bytes()).hexdigest(), None))
    got = trees.tree_hashes(trees.folder_entries(spark, f"file://{tmp_path}", "t")).collect()
    assert [(r["entries"], r["tree_sha256"]) for r in got] == [_tree(entries)]


# --- recovery

T0 = datetime.datetime(2024, 1, 1, 12)


def _at(s):
    return T0 + datetime.timedelta(seconds=s)


def _recovered(spark, job, ledger=(), shown=(), now=100):
    rows = [("j", a, k, c, _at(s), lat, tok, cost, floor) for a, k, c, s, lat, tok, cost, floor in ledger]
    df = spark.createDataFrame(rows, "job_id string, attempt int, kind string, call_id string, happened_at timestamp, latency_ms double, tokens long, cost double, floor_ms double")
    out = recovery.recoveries(spark.createDataFrame([("j", *job)], "job_id string, status string, attempts int, contracted boolean"), df, spark.createDataFrame([("j", s) for s in shown], "job_id string, artifact string"), F.lit(_at(now)).cast("timestamp"), 1200)
    return [(r["action"], r["reason"], r["attempt"], r["tokens"], None if r["cost"] is None else float(r["cost"]), r["elapsed_ms"]) for r in out.collect()]


def _admitted(a, s=0, floor=None):
    return a, "admitted", None, s, None, None, None, floor


def _ended(a, s=50):
    return a, "terminal", None, s, None, None, None, None


def _began(a, c, s=1):
    return a, "call_started", c, s, None, None, None, None


def _done(a, c, s=2, lat=1000.0, tok=7, cost=0.25):
    return a, "call_completed", c, s, lat, tok, cost, None


def test_recovery_reasons(spark):
    running = ("running", 1, True)
    whole = [_admitted(1), _began(1, "x"), _done(1, "x"), _began(1, "y"), _done(1, "y", 30, 250000.0, 3, 0.5)]
    cases = [
        (("completed", 1, True), whole, (), 100, None),
        (running, whole, (), 100, ("recovered", "interrupted", 1, 10, 0.75, 251000.0)),  # latencies exceed the wall
        (running, whole[:3], (), 100, ("recovered", "interrupted", 1, 7, 0.25, 100000.0)),  # the wall
        (running, [_admitted(1, 0, 3e6), *whole[1:3]], (), 100, ("recovered", "interrupted", 1, 7, 0.25, 3e6)),  # the floor
        (running, [*whole[:3], whole[2]], (), 100, ("recovered", "interrupted", 1, 7, 0.25, 100000.0)),  # a receipt twice
        (running, [_admitted(1)], (), 100, ("recovered", "interrupted", 1, 0, 0.0, 100000.0)),
        (running, whole[:4], (), 100, ("refused", "unknown_usage")),
        (running, [*whole[:2], _done(1, "z")], (), 100, ("refused", "unknown_usage")),
        (running, whole, (), 29, ("refused", "clock")),
        (running, whole[:1], (), -1, ("refused", "clock")),
        (running, whole[1:3], (), 100, ("refused", "no_marker")),
        (running, whole, ("trace",), 100, ("left", "trace_published")),
        (running, whole, ("report",), 100, ("refused", "artifact_residue")),
        (running, [*whole, _ended(1)], (), 100, ("left", "all_ended")),
        (("running", 1, False), whole, (), 100, ("refused", "outside_contract")),
        (("running", 1, None), whole, (), 100, ("refused", "outside_contract")),
        (("running", None, True), whole, (), 100, ("refused", "no_admission")),
        (running, [], (), 100, ("recovered", "admission_gap", 1, 0, 0.0, 1_200_000.0)),
        (("running", 2, True), [*whole, _ended(1)], (), 100, ("recovered", "admission_gap", 2, 0, 0.0, 1_200_000.0)),
        (("running", 2, True), [*whole, _ended(1)], ("patch",), 100, ("refused", "artifact_residue")),
        (("running", 2, True), whole, (), 100, ("refused", "open_attempt_before_gap")),
        (("running", 3, True), whole, (), 100, ("refused", "attempt_count")),
        (("running", 2, True), [*whole, _admitted(2)], (), 100, ("refused", "not_the_latest")),
        (("running", 2, True), [*whole, _admitted(2), _ended(2)], (), 100, ("refused", "not_the_latest")),
        (("running", 2, True), [_admitted(1), _ended(1), _admitted(2, 40), _began(2, "x", 41), _done(2, "x", 42)], (), 100, ("recovered", "interrupted", 2, 7, 0.25, 60000.0)),
    ]
    for job, ledger, shown, now, want in cases:
        got = _recovered(spark, job, ledger, shown, now)
        assert got == ([] if want is None else [want + (None,) * (6 - len(want))]), (job, ledger, want)


# --- curated records

RECORD = "record_index long, task_id string, source_instance_id string, hidden_test_patch string, hidden_test_commands array<string>, public_behavior_summary string, withheld_evaluator_notes string"


def _record(n, task, source, **changes):
    return tuple({"n": n, "task": task, "source": source, "patch": f"diff {n}", "commands": [f" run {n} "], "summary": "works", "notes": "n", **changes}.values())


def _curated(spark, tasks, sources, records):
    t = spark.createDataFrame(tasks, "task_id string, source_instance_id string")
    s = spark.createDataFrame(sources, "source_instance_id string, test_patch string, test_commands array<string>, verifier_types array<string>, extra int")
    r = spark.createDataFrame(records, RECORD).repartition(3)
    placed = curation.buckets(t, r, curation.patch_errors(hidden=("oracle",)))
    return t, s, r, placed


def test_records_fall_into_their_buckets(spark):
    tasks = [("t1", "s1"), ("t2", "s2"), ("t3", "s9"), ("t4", "s4"), (" ", "s5")]
    sources = [("s1", "old", ["c"], ["unit_test"], 1), ("s2", "old", None, None, 2), ("s3", "old", ["c"], [], 3), ("s1", "old", ["c"], ["unit_test"], 4), (None, None, None, None, 5)]
    records = [
        _record(0, "t1", "s1", patch=" "), _record(1, " t1 ", "s1"), _record(2, "t1", "s1"), _record(3, "t1", "s1", patch=None), _record(4, " ", "s1"), _record(5, None, "s1"), _record(6, "t9", "s1"),
        _record(7, "t2", "s1"), _record(8, "t2", ""), _record(9, "t2", "s2", commands=[]), _record(10, "t2", "s2", commands=["a", " "]), _record(11, "t2", "s2", summary="the Oracle says", notes=None), _record(12, "t3", "s9"),
    ]
    t, s, r, placed = _curated(spark, tasks, sources, records)
    got = {x["record_index"]: (x["bucket"], x["reason"], x["errors"]) for x in placed.collect()}
    assert got == {
        0: ("invalid", "malformed", ["hidden_test_patch"]), 1: ("applied", "", []), 2: ("invalid", "double", []), 3: ("invalid", "double", []), 4: ("invalid", "no_task", []), 5: ("invalid", "no_task", []), 6: ("unused", "unknown_task", []),
        7: ("invalid", "malformed", ["other_source_instance_id"]), 8: ("invalid", "malformed", ["source_instance_id"]), 9: ("invalid", "malformed", ["hidden_test_commands"]), 10: ("invalid", "malformed", ["hidden_test_commands"]),
        11: ("invalid", "malformed", ["summary_holds:oracle", "withheld_evaluator_notes"]), 12: ("applied", "", []),
    }
    out = {x["extra"]: x for x in curation.apply(t, s, r, placed).collect()}
    assert len(out) == len(sources)
    for k in (1, 4):
        x = out[k]
        assert (x["test_patch"], x["test_commands"], x["verifier_types"], x["curation_task_id"]) == ("diff 1", ["run 1"], ["hidden_test_patch", "unit_test"], "t1") and x["hidden_test_patch_sha256"] == hashlib.sha256(b"diff 1").hexdigest()
    assert [(out[k]["test_patch"], out[k]["curation_task_id"]) for k in (2, 3, 5)] == [("old", None), ("old", None), (None, None)]
    assert {x["task_id"] for x in curation.remaining(t, placed).collect()} == {"t2", "t4"}
    assert [x[0] for x in curation.absent(t, s, placed).collect()] == ["s9"]
    assert tuple(curation.summary(t, s, placed).first()) == (2, 10, 1, 2, 1, False, False)


def test_no_records_and_no_tasks(spark):
    t, s, r, placed = _curated(spark, [("t1", "s1")], [("s1", "old", None, None, 1)], [])
    assert placed.count() == 0 and tuple(curation.summary(t, s, placed).first()) == (0, 0, 0, 1, 0, True, False)
    assert curation.apply(t, s, r, placed).first()["test_patch"] == "old"
    t, s, r, placed = _curated(spark, [], [], [_record(0, "t", "s")])
    assert placed.first()["bucket"] == "unused" and curation.apply(t, s, r, placed).count() == 0


# --- admission


def _loop(rows, budgets, settle):
    """Job after job: those at least ``settle`` places back have settled, the others hold their worst case."""
    for k in range(len(rows)):
        done = {c: sum(r[c] or 0 for r in rows[: max(0, k - settle + 1)]) for c in budgets}
        held = min(k, settle - 1)
        reasons = []
        for c, (limit, worst) in budgets.items():
            if done[c] >= limit:
                reasons.append(f"{c}_spent")
            if worst and done[c] + (held + 1) * worst > limit:
                reasons.append(f"{c}_reserved")
        if reasons:
            return k, reasons
    return len(rows), []


@pytest.mark.parametrize("settle", [1, 3, 8])
def test_admission_equals_a_plain_loop(spark, settle):
    rng = random.Random(settle)
    for n, budgets in [(200, {"tokens": (4000, 60), "cost": (10**9, 0)}), (200, {"tokens": (10**6, 50), "cost": (900, 12)}), (50, {"tokens": (10**6, 0), "cost": (10**6, 5)}), (5, {"tokens": (10, 60)}), (30, {"tokens": (0, 0)})]:
        rows = [{"job_id": f"j{k:04d}", "tokens": rng.choice([None, rng.randint(0, 50)]), "cost": rng.randint(0, 12)} for k in range(n)]
        stop, reasons = _loop(rows, budgets, settle)
        shuffled = rng.sample(rows, n)
        for parts in (1, 5):
            df = spark.createDataFrame([(r["job_id"], r["tokens"], r["cost"]) for r in shuffled], "job_id string, tokens long, cost long").repartition(parts)
            got = sorted(jobs.reserved_prefix(df, budgets, settle=settle).collect(), key=lambda r: r["job_id"])
            assert [r["position"] for r in got] == list(range(1, n + 1))
            assert [r["admitted"] for r in got] == [k < stop for k in range(n)]
            assert [r["reasons"] for r in got] == [reasons if k == stop else [] for k in range(n)]
    assert jobs.reserved_prefix(spark.createDataFrame([], "job_id string, tokens long"), {"tokens": (1, 1)}).count() == 0


# --- test commands


def test_commands_quote_like_a_shell(spark):
    ids = ["tests/a.py::test_b", "a b", "it's", "", "$HOME `x`", "é", 'q"x', "p[1-[2]]", "p[3]", "a\tb", "x@%+=:,./-_"]
    df = spark.createDataFrame([(ids, "pytest {test} --id={test} {{x}}"), (ids, ""), (ids, None), ([], "pytest {test}"), (None, "p {test}"), (["b", "a", "b[1]"], "{test}"), (["ok"], "plain"), (["ok"], "{other} {test}"), (["ok"], "{test"), ([], "{other}"), (["ok", "-x"], "{test}"), (["a\nb", "-x"], "{test}"), (["a\0"], "{test}"), (["a\rb"], ""), (["ok", None], "{test}")], "ids array<string>, template string")
    got = [(r["c"]["commands"], r["c"]["fault"]) for r in df.select(commands.test_commands(F.col("ids"), F.col("template")).alias("c")).collect()]
    quoted = [shlex.quote(i.split("[", 1)[0]) for i in ids]
    assert got[0] == (list(dict.fromkeys(f"pytest {q} --id={q} {{x}}" for q in quoted)), "")
    assert got[1:] == [([], ""), ([], ""), ([], ""), ([], ""), (["b", "a"], ""), (["plain"], ""), ([], "template"), ([], "template"), ([], ""), ([], "option"), ([], "control_character"), ([], "control_character"), ([], ""), ([], "missing_test_id")]
    for q, i in zip(quoted, ids, strict=True):
        assert shlex.split(q) == [i.split("[", 1)[0]]


def test_verifiers_and_tags_of_records(spark):
    cases = [
        ({}, [], [], ["source_format:f", "task_family:x", "w"]),
        ({"hidden_tests": None, "test_commands": ["a", " a ", "", None, 3], "FAIL_TO_PASS": ["t[1]", "t[2]"], "build_commands": "make"}, [("build_command", ["make"]), ("hidden_command", ["a", "3", "run t"])], ["build_command", "hidden_command"], None),
        ({"hidden_tests": [], "test_commands": ["never"], "test_ids": ["-x", "ok"]}, [], [], None),
        ({"eval_commands": {"a": 1}, "doctest_commands": ["d"], "adversarial_tests": ["z"]}, [("adversarial_test", ["z"]), ("doctest", ["d"])], ["adversarial_test", "doctest"], None),
        ({"required_state": {}, "forbidden_state": {"a": None}, "performance_threshold": 0, "trace_quality_rubric": None, "diff_constraints": [""], "retrieval_requirements": "r", "patch": "p", "test_patch": " "}, [], ["forbidden_state", "performance_threshold", "reference_patch", "retrieval_evidence"], None),
        ({"verifier_types": ["Unit Test", "unit-test", "build_command"], "build_commands": ["m"], "language": " Go ", "coverage_tags": ["b", "w"]}, [("build_command", ["m"])], ["build_command", "unit_test"], ["b", "language:Go", "source_format:f", "task_family:x", "verifier:build_command", "verifier:unit_test", "w"]),
    ]
    rows = [(k, json.dumps(r)) for k, (r, *_) in enumerate(cases)] + [(99, None), (98, "no json")]
    df = spark.createDataFrame(rows, "k int, raw string").select("k", F.try_parse_json("raw").alias("v")).withColumn("g", commands.command_groups(F.col("v"), F.lit("run {test}")))
    df = df.withColumn("t", commands.verifier_types(F.col("v"), F.col("g"))).withColumn("tags", commands.coverage_tags(F.col("v"), F.lit("x"), F.lit("f"), F.lit(""), F.col("t"), F.array(F.lit("w"))))
    got = {r["k"]: r for r in df.drop("v").collect()}
    for k, (_, groups, types, tags) in enumerate(cases):
        assert [(g["verifier_type"], g["commands"]) for g in got[k]["g"]] == groups and got[k]["t"] == types and (tags is None or got[k]["tags"] == tags), k
    assert got[99]["g"] == got[98]["g"] == got[99]["t"] == []
    assert [r[0] for r in df.where("k = 1").select(commands.all_commands(F.col("g"))).collect()] == [["make", "a", "3", "run t"]]
