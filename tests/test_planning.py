"""Plans of collections, remediation and evidence, and release reports, against cases worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trajlake.operators import planning, release

PLAN = "valid boolean, total_tasks long"
TASKS = "position long, collection_source string, repository string"
FILES = "path string, role string, present boolean, readable boolean"


def _preflight(spark, plan=((True, 3),), tasks=((5, "issues", "a"), (7, "Pull-Requests", "b"), (9, "ci", "c")), files=(), **more):
    made = [spark.createDataFrame(list(x), t) for x, t in ((plan, PLAN), (tasks, TASKS), (files, FILES))]
    return {tuple(r) for r in planning.preflight_issues(*made, **more).collect()}


def test_every_preflight_code(spark):
    def general(code):
        return (code, None, None, None)

    assert _preflight(spark) == set()
    assert _preflight(spark, plan=[]) == {general("source_collection_plan_invalid")}
    assert _preflight(spark, plan=[], tasks=[(1, "odd", "x")], files=[("f", "summary", False, None)]) == {general("source_collection_plan_invalid")}
    assert _preflight(spark, plan=[(None, None)]) == {general("source_collection_plan_invalid")}
    assert _preflight(spark, plan=[(True, -1)]) == {general("missing_collection_plan_tasks")}
    assert _preflight(spark, plan=[(True, 0)], tasks=[]) == {general("missing_collection_plan_tasks"), general("no_selected_collection_tasks")}
    assert _preflight(spark, offset=3) == {general("no_selected_collection_tasks")} and _preflight(spark, most=0) == {general("no_selected_collection_tasks")} and _preflight(spark, offset=-4, most=-1) == {general("no_selected_collection_tasks")}
    odd = [(5, "wiki", " a "), (7, None, "b"), (9, "ci", "c"), (11, "wiki", "d")]
    assert _preflight(spark, tasks=odd, most=3) == {("unsupported_collection_task", 0, "a", None), ("unsupported_collection_task", 1, "b", None)}
    assert _preflight(spark, tasks=odd, offset=2, most=9) == {("unsupported_collection_task", 3, "d", None)}
    assert _preflight(spark, token_required=True) == {general("missing_token")} and _preflight(spark, token_required=True, token_given=True) == set()
    files = [("s", "source", False, None), ("t", "source", True, False), ("u", "source", True, True), ("v", "summary", None, True), ("w", "summary", True, None), ("x", "summary", True, True)]
    unread = {("source_records_invalid", None, None, "t"), ("missing_collection_summary", None, None, "v"), ("collection_summary_invalid", None, None, "w")}
    assert _preflight(spark, files=files) == unread and _preflight(spark, files=files, source_required=True) == unread | {("missing_source_records", None, None, "s")}


EXPORT = "valid boolean, plan_tasks long, selected_tasks long, skipped_tasks long, exported long, issues long"
AUDIT = "valid boolean, total long, accepted long, quarantined long"


def _ready(spark, plan=((True, 2),), tasks=(("issues",), ("ci",)), export=((True, 2, 2, 0, 5, 0),), audit=((True, 5, 5, 0),), accepted=(("Issue",),), **more):
    made = [spark.createDataFrame(list(x), t) for x, t in ((plan, PLAN), (tasks, "collection_source string"), (export, EXPORT), (audit, AUDIT), (accepted, "source_type string"))]
    return {(r["code"], r["severity"]): r["detail"] for r in planning.readiness(*made, **more).collect()}


@pytest.mark.parametrize(
    ("changes", "want"),
    [
        ({}, {}),
        ({"plan": [(False, 2)]}, {("source_collection_plan_invalid", "error"): ""}),
        ({"plan": [(True, 0)], "tasks": []}, {("missing_collection_plan_tasks", "error"): "", ("missing_supported_collection_tasks", "error"): ""}),
        ({"tasks": [("wiki",), (None,)]}, {("missing_supported_collection_tasks", "error"): ""}),
        ({"export": [(None, 2, 2, 0, 5, None)]}, {("source_export_summary_invalid", "error"): ""}),
        ({"audit": [(False, 5, 5, None)]}, {("source_collection_audit_failed", "error"): ""}),
        ({"least_accepted": 6}, {("accepted_records_below_minimum", "error"): "5 against 6"}),
        ({"audit": [(True, 5, 3, 2)], "most_quarantined": 1}, {("quarantine_budget_exceeded", "error"): "2 against 1"}),
        ({"audit": [(True, 4, 5, 0)]}, {("audit_export_count_mismatch", "error"): "4 against 5"}),
        ({"export": [(True, 3, 3, 0, 5, 0)]}, {("plan_export_task_count_mismatch", "error"): "2 against 3"}),
        ({"export": [(True, 0, 1, 0, 5, 0)], "all_tasks": True}, {("partial_plan_selection", "error"): "1 against 2"}),
        ({"source_types": ("issue", "ci_run")}, {("missing_required_source_type", "error"): "ci_run"}),
        ({"export": [(True, 2, 2, 4, 5, 3)]}, {("source_export_issues", "warning"): "3", ("skipped_collection_tasks", "warning"): "4"}),
        ({"export": [(True, 2, 2, 0, 5, 3)], "clean_export": True}, {("source_export_issues", "error"): "3"}),
    ],
)
def test_every_readiness_condition(spark, changes, want):
    assert _ready(spark, **changes) == want


def test_readiness_without_summaries(spark):
    got = _ready(spark, plan=[], tasks=[], export=[], audit=[], accepted=[])
    assert {c for c, _ in got} == {"source_collection_plan_invalid", "missing_collection_plan_tasks", "missing_supported_collection_tasks", "source_export_summary_invalid", "source_collection_audit_failed", "accepted_records_below_minimum"}


SLOT = "slot_id int, type string, target string, dimension string, dominant_label string, minimum_count int"


def test_actions_candidates_and_issues_of_slots(spark):
    slots = [
        (1, "share_cap_diversity", "t", "language", "python", 3), (2, "share_cap_diversity", "t", "repository", "o/a", 2), (3, "share_cap_diversity", "t", "repository", "o/b", 1), (4, "share_cap_diversity", "build_command", "source", None, 1),
        (5, "source_method_minimum", "public_issue_workspace", None, None, 1), (6, "source_method_minimum", "x", None, None, 1), (7, "verifier_type_minimum", "build_command", None, None, None), (8, "verifier_type_minimum", "hidden_test_patch", None, None, 1), (9, None, None, None, None, 1),
    ]
    df = planning.remediation(spark.createDataFrame(slots, SLOT))
    actions = {r["slot_id"]: r["action"] for r in df.collect()}
    assert actions == {1: "collect_cross_language_sources", 2: "collect_non_dominant_repository_sources", 3: "collect_non_dominant_repository_sources", 4: "collect_share_cap_diversity_sources", 5: "collect_public_issue_sources", 6: "satisfy_reserved_backfill_slot", 7: "collect_build_command_evidence", 8: "curate_hidden_test_patch_evidence", 9: "satisfy_reserved_backfill_slot"}

    def allow(*rows):
        return spark.createDataFrame(list(rows), "repository string, language string")

    given = allow(("o/a", "Python"), ("o/a", "Python"), (" o/c ", "Go"), ("o/d", None), (" ", "rust"))
    assert {tuple(r) for r in planning.remediation_candidates(df, given).collect()} == {("collect_cross_language_sources", "o/c", 1), ("collect_non_dominant_repository_sources", "o/a", 1), ("collect_non_dominant_repository_sources", "o/c", 2), ("collect_non_dominant_repository_sources", "o/d", 2)}

    def issues(planned, allowed):
        return {tuple(r) for r in planning.remediation_issues(planned, allowed).collect()}

    assert issues(df, given) == set()
    assert issues(df, allow(("o/a", "python"))) == {("missing_cross_language_allowlist_candidate", "error"), ("missing_non_dominant_repository_candidate", "error")}
    assert issues(df.where("slot_id = 3"), allow(("o/a", "go"))) == set() and issues(df, allow(("", "go"))) == {("missing_cross_language_allowlist_candidate", "error"), ("missing_non_dominant_repository_candidate", "error")}
    assert issues(df, given.limit(0)) == {("allowlist_not_provided", "warning")} and issues(df.limit(0), given) == {("no_reserved_backfill_slots", "warning")}
    assert planning.remediation_candidates(df, given.limit(0)).count() == planning.remediation_candidates(df.limit(0), given).count() == 0


TARGET = "struct<name string, doctest_commands array<string>, example_commands array<string>, benchmark_commands array<string>, performance_threshold map<string,double>>"
SPEC = f"spec_id int, repository string, source_revision string, task_families array<string>, targets array<{TARGET}>, doctest_commands array<string>, example_commands array<string>, benchmark_commands array<string>, performance_threshold map<string,double>"


def test_missing_evidence_of_specs(spark):
    bare = ("t", None, None, None, None)
    rows = [
        (1, "r", "v", ["docs_examples", "Performance", "refactor"], [bare, ("u", ["d"], None, None, {"max": 1.0})], None, None, None, None),
        (2, "r", "v", ["docs-examples"], None, None, [" ", "run"], None, None),  # the spec's own example
        (3, "r", "v", ["docs_examples"], None, [" ", None], [], None, None),
        (4, "r", "v", ["performance"], [bare], None, None, None, {"max": 2.0}),
        (5, "r", "v", ["performance"], [("t", ["d"], ["e"], [], {})], None, None, [None], None),
        (6, "r", "v", None, [bare], None, None, None, None),
        (7, "r", "v", ["docs_examples"], [], None, None, None, None),
    ]
    got = planning.missing_evidence(spark.createDataFrame(rows, SPEC))
    assert {(r["spec_id"], r["task_family"], r["target_name"], r["missing"]) for r in got.collect()} == {
        (1, "docs_examples", "t", "doctest_or_example_command"), (1, "performance", "t", "benchmark_command_or_performance_threshold"), (3, "docs_examples", "", "doctest_or_example_command"), (5, "performance", "t", "benchmark_command_or_performance_threshold"),
    }
    assert {tuple(r) for r in planning.evidence_counts(got).collect()} == {("task_family", "docs_examples", 2), ("task_family", "performance", 2), ("missing", "doctest_or_example_command", 2), ("missing", "benchmark_command_or_performance_threshold", 2)}
    ids = sorted(r["evidence_task_id"] for r in got.select("evidence_task_id").distinct().collect())
    assert len(ids) == 3  # spec 1 and 5 ask for the same benchmark of the same target
    shards = {r["shard_id"]: r["evidence_task_ids"] for r in planning.first_of_shards(got, 2).collect()}
    assert shards == {"shard_000000": ids[:2], "shard_000001": ids[2:]}
    schedule = spark.createDataFrame([("a", [ids[0], "evidence_x", ""]), ("b", [ids[0]]), ("c", [])], "shard_id string, evidence_task_ids array<string>")
    filled = {(r["shard_id"], r["evidence_task_id"], r["outcome"]) for r in planning.evidence_templates(got, schedule).collect()}
    assert filled == {("a", ids[0], "template"), ("a", "evidence_x", "absent"), ("b", ids[0], "template")}


# --- release

RUN = "job_id string, trace_id string, scenario_id string, termination_reason string, reward int, success boolean, infrastructure_failure boolean, tokens long, elapsed_ms double, semantic_hash string"
TARGETS = release.Targets(trajectories=4, successes=2, sft=2, rl=2, preference=1, run_tokens=100, run_seconds=1.0, total_tokens=400, total_cost="1.5", total_seconds=4.0)
FINE = {
    "runs": ([("j1", "t1", "s1", "success", 1, True, False, 100, 1000.0, "h1"), ("j2", "t2", "s1", None, 0, False, False, 10, 5.0, "h2"), ("j3", "t3", "s2", "success", 1, True, False, 10, 5.0, "h3"), ("j4", "t4", "s2", "timeout", 1, False, False, 10, 5.0, "h4")], RUN),
    "leaks": ([], "trace_id string"), "bypasses": ([], "trace_id string"), "reproductions": ([("t1", True), ("t3", True)], "trace_id string, reproduced boolean"),
    "contracted": ([(f"j{k}",) for k in range(1, 5)], "job_id string"), "jobs": ([(f"j{k}", "completed") for k in range(1, 5)], "job_id string, status string"),
    "ledger": ([("j1", 200, "0.75", 2000.0), ("j2", 200, "0.75", 2000.0)], "job_id string, tokens long, cost string, elapsed_ms double"), "ledger_issues": ([], "code string"),
    "reproduction": ([(True, True, True, True, 2, 2, 2, 2)], "independent boolean, artifacts_valid boolean, semantic_match boolean, hash_match boolean, required long, reproductions long, reproduced long, executed long"),
    "exports": ([("analysis", 4, True), ("rl", 2, True), ("sft", 2, True), ("preference", 1, True)], "name string, records long, gate boolean"),
    "export_quarantine": ([], "trace_id string"), "reviews": ([(True,)], "passed boolean"), "review_quarantine": ([], "trace_id string"),
}


def _report(spark, **changes):
    t = {k: spark.createDataFrame(changes.get(k, rows), schema) for k, (rows, schema) in FINE.items()}
    judged = release.judged_runs(t["runs"], t["leaks"], t["bypasses"], t["reproductions"], TARGETS)
    return judged, t, release.report(judged, *[t[k] for k in ("contracted", "jobs", "ledger", "ledger_issues", "reproductions", "reproduction", "exports", "export_quarantine", "reviews", "review_quarantine")])


def _failed(spark, **changes):
    got = release.gates(_report(spark, **changes)[2], TARGETS).orderBy("position").collect()
    assert [r["gate"] for r in got] == list(release.GATES)
    return {r["position"] + 1 for r in got if not r["passed"]}


def test_each_gate_of_a_release(spark):
    runs = FINE["runs"][0]

    def run(k, **changes):
        names = [c.split()[0] for c in RUN.split(", ")]
        return [tuple({**dict(zip(names, r, strict=True)), **(changes if n == k else {})}.values()) for n, r in enumerate(runs)]

    cases = [
        ({}, set()),
        ({"runs": runs[:3]}, {1, 2}),
        ({"contracted": FINE["contracted"][0][:3], "runs": runs[:3]}, {1}),
        ({"jobs": [("j1", "completed"), ("j2", "infrastructure_failed"), ("j9", "infrastructure_failed")]}, {3}),
        ({"leaks": [("t2",), ("t2",), ("t9",)]}, {4}),
        ({"bypasses": [("t2",)]}, {5}),
        ({"reproduction": [(True, False, True, True, 2, 2, 2, 2)]}, {6}),
        ({"reproduction": []}, {6, 7, 8}),
        ({"reproductions": [("t1", True), ("t3", True), ("t3", None)]}, {7}),
        ({"reproductions": [("t1", True)]}, {7}),
        ({"reproduction": [(True, True, True, True, 2, 2, 2, 1)]}, {8}),
        ({"runs": run(2, success=False), "reproductions": [("t1", True)], "reproduction": [(True, True, True, True, 1, 1, 1, 1)]}, {9}),
        ({"runs": run(0, tokens=101)}, {10}),
        ({"runs": run(0, elapsed_ms=1000.5)}, {11}),
        ({"ledger": [("j1", 401, "1.5", 4000.0)]}, {12}),
        ({"ledger": [("j1", 400, "1.5000000001", 4000.0)]}, {13}),
        ({"ledger": [("j1", 400, "1.5", 4000.001)]}, {14}),
        ({"ledger_issues": [("x",)]}, {15}),
        ({"exports": [("analysis", 4, True), ("rl", 2, True), ("sft", 2, None), ("preference", 1, True)]}, {16}),
        ({"exports": [("analysis", 4, True), ("rl", 2, True), ("sft", 1, True), ("preference", 1, True)]}, {17}),
        ({"exports": [("analysis", 4, True), ("rl", 1, True), ("sft", 2, True), ("preference", 1, True)]}, {18}),
        ({"exports": [("analysis", 4, True), ("rl", 2, True), ("sft", 2, True), ("preference", 0, True)]}, {19, 20}),
        ({"exports": [("analysis", 4, True), ("rl", 2, True), ("sft", 2, True), ("preference", 2, True)]}, {20}),
        ({"runs": run(3, reward=0)}, {20}),
        ({"runs": run(1, infrastructure_failure=True), "exports": [("rl", 2, True), ("sft", 2, True), ("preference", 1, False)]}, {20, 22}),
        ({"exports": []}, {16, 17, 18, 19, 20, 21, 22, 24}),
        ({"reviews": [(None,)]}, {23, 24}),
        ({"reviews": []}, {23, 24}),
        ({"review_quarantine": [("t4",)]}, {24}),
        ({"review_quarantine": [("t4",), ("t4",)], "export_quarantine": [("t4",)]}, set()),
        ({"review_quarantine": [("t1",)], "export_quarantine": [("t1",)]}, {20}),
    ]
    for changes, want in cases:
        assert _failed(spark, **changes) == want, changes


def test_findings_counts_and_empty_runs(spark):
    judged, t, summary = _report(spark, leaks=[("t2",), ("t2",)], runs=[*FINE["runs"][0][:3], ("j4", "t1", "s2", None, None, None, None, 200, None, "h1")], jobs=[("j3", "infrastructure_failed"), ("j8", "infrastructure_failed")])
    found = {tuple(r) for r in release.finding_ids(judged, t["contracted"], t["jobs"]).collect()}
    assert found == {("leak", "t2"), ("agent_token_budget", "t1"), ("infrastructure", "j3")}
    row = summary.first()
    assert (row["duplicate_traces"], row["semantic_duplicates"], row["successes"], row["infrastructure"]) == (1, 1, 2, 1)
    tools = spark.createDataFrame([("t1", "x"), ("t1", "x"), ("t2", None), ("t9", "x")], "trace_id string, tool string")
    assert {tuple(r) for r in release.count_maps(judged, tools).collect()} == {("termination", "success", 2), ("termination", "missing", 2), ("reward", "1", 2), ("reward", "0", 1), ("reward", None, 1), ("tool", "x", 2), ("tool", "unknown", 1)}
    empty = release.gates(_report(spark, **{k: [] for k in FINE})[2], TARGETS).where(F.col("passed")).collect()
    assert {r["position"] + 1 for r in empty} == {2, 3, 4, 5, 10, 11, 12, 13, 14, 15}


def test_states_of_evidence_shards(spark):
    """Each state of a shard, from what stands in its artifacts."""
    full = {"records": ("present", None, None, None), "apply": ("present", True, 0, None), "spec": ("present", None, None, 1)}
    cases = {
        "a": ({}, "pending", "collect_evidence", 2), "b": ({"template": ("present", None, None, None)}, "pending", "fill_evidence_template", 2), "c": ({"template": ("invalid", None, None, None)}, "blocked", "fix_evidence_template", 2),
        "d": ({"records": ("invalid", None, None, None)}, "blocked", "fix_evidence_records", 2), "e": ({"records": full["records"]}, "ready_to_apply", "apply_evidence", 2), "f": ({**full, "apply": ("invalid", None, None, None)}, "blocked", "inspect_apply_output", 0),
        "g": ({**full, "apply": ("present", None, 0, None)}, "blocked", "resolve_apply_errors", 0), "h": (full, "partial", "collect_remaining_evidence", 1), "i": ({k: full[k] for k in ("records", "apply")}, "ready_to_finalize", "write_spec_output", 0),
        "j": ({**full, "spec": ("present", None, None, 0)}, "blocked", "fix_spec_output", 0), "k": ({**full, "spec": ("invalid", None, None, 3)}, "blocked", "fix_spec_output", 0), "l": (full, "complete", "none", 0), "m": ({**full, "apply": ("present", True, 4, None)}, "partial", "collect_remaining_evidence", 4),
    }
    shards = spark.createDataFrame([(s, 2) for s in cases], "shard_id string, selected_tasks long")
    artifacts = spark.createDataFrame([(s, kind, *row) for s, (kinds, *_) in cases.items() for kind, row in kinds.items()], "shard_id string, kind string, state string, valid boolean, remaining long, repositories long")
    tasks = [(s, t) for s in cases if s != "m" for t in ("x", "y")]
    applied = [(s, t) for s, t in tasks if (s, t) != ("h", "y")] + [("l", "z")]
    records = [("l", "x"), ("l", "x"), ("l", "q"), ("l", ""), ("l", None), ("a", "x")]
    ids = [spark.createDataFrame(x, "shard_id string, evidence_task_id string") for x in (tasks, records, applied)]
    got = {r["shard_id"]: r for r in planning.evidence_shard_states(shards, artifacts, *ids).collect()}
    assert {s: (r["status"], r["next_action"], r["remaining"]) for s, r in got.items()} == {s: tuple(want) for s, (_, *want) in cases.items()}
    assert [got["l"][c] for c in ("records", "matching", "absent", "extra")] == [5, 1, 1, 1] and [got["a"][c] for c in ("records", "matching", "absent", "extra")] == [0, 0, 2, 0]
    assert planning.evidence_shard_states(shards.limit(0), artifacts, *ids).count() == 0
