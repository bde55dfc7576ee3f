"""Source records as JSON and nested usage, against plain rules in Python."""

from __future__ import annotations

import json
import random

import pytest

from trajlake.operators import source_records, usage

GOOD = {"repository": "Org/A", "title": "T", "body": "b", "labels": ["x"], "license": "MIT", "language": "go", "source_instance_id": "i", "test_commands": ["run"], "source_url": "https://github.com/a/b", "source_revision": "aB" * 20, "source_type": "issue"}


def _codes(spark, *records):
    df = spark.createDataFrame([(k, r if r is None or isinstance(r, str) else json.dumps(r)) for k, r in enumerate(records)], "position int, raw string")
    out = [set() for _ in records]
    for r in source_records.record_issues(df).collect():
        out[r["position"]].add(r["code"])
    return out


def _without(*names, **more):
    return {**{k: v for k, v in GOOD.items() if k not in names}, **more}


def test_every_check_of_a_record(spark):
    cases = [
        (GOOD, set()), (_without("repository"), {"missing_repository"}), (_without("repository", owner="o", name="n"), set()), (_without("repository", name="n"), {"missing_repository"}), (_without(repository="  "), {"missing_repository"}),
        (_without(title=[1]), {"missing_title"}), (_without(title=7), set()), (_without(body=None), {"missing_body"}), (_without(labels=""), {"missing_labels"}), (_without(labels="bug"), set()), (_without(labels=["", None]), set()), (_without(labels=[""]), {"missing_labels"}), (_without(labels={"a": 1}), {"missing_labels"}),
        (_without("license"), {"missing_license"}), (_without(language=" "), {"missing_language"}), (_without("source_instance_id"), set()), (_without("source_instance_id", "source_url"), {"missing_source_instance_id", "missing_source_url"}), (_without("source_instance_id", "source_url", number=4), {"missing_source_url"}),
        (_without("test_commands"), {"missing_candidate_verifier"}), (_without("test_commands", forbidden_state={}), {"missing_candidate_verifier"}), (_without("test_commands", forbidden_state={"a": None}), set()), (_without("test_commands", hidden_tests="t"), set()),
        (_without(source_revision="short"), {"missing_fixed_revision"}), (_without("source_revision", commit="0" * 40), set()), (_without(source_url="ftp://a.b/x"), {"non_public_source_url"}), (_without(source_url="https://user@go/x"), {"non_public_source_url"}), (_without(source_url="https://localhost/x"), {"non_public_source_url", "private_url"}),
        (_without(notes=[{"deep": ["see GIT@host"]}]), {"private_url"}),
    ]
    for (record, want), got in zip(cases, _codes(spark, *[c for c, _ in cases]), strict=True):
        assert got == want, record
    every = {"missing_repository", "missing_title", "missing_body", "missing_labels", "missing_license", "missing_language", "missing_source_instance_id", "missing_candidate_verifier", "missing_source_url", "missing_fixed_revision"}
    assert _codes(spark, None, "no json", "[]", "{}") == [every] * 4
    ids = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate([_without("source_instance_id", "title", number=5, source_type="PR"), _without("source_instance_id", "title", pr_number="7", source_type="ci-failure"), _without("source_instance_id", "title")])], "position int, raw string")
    assert {r["position"]: r["source_instance_id"] for r in source_records.record_issues(ids).collect()} == {0: "org__a-pr-5", 1: "org__a-ci-7", 2: "https://github.com/a/b"}


@pytest.mark.parametrize(
    ("changes", "code"),
    [
        ({}, ""), ({"source_type": "pull-requests"}, ""), ({"source_type": "wiki"}, "unsupported_source_type"), ({"source_type": "ci"}, "unsupported_source_type"), ({"title": " "}, "missing_required_public_source_fields"), ({"source_revision": "x"}, "invalid_source_revision"),
        ({"dataset": "SWE bench"}, "benchmark_source_rejected"), ({"metadata": {"benchmark": "multi-SWE-bench"}}, "benchmark_source_rejected"), ({"contamination_tags": ["ok", "swe_bench_lite"]}, "benchmark_source_rejected"), ({"patch": None}, "oracle_fields_rejected"),
        ({"source_url": "https://gitlab.com/a"}, "other_source_url"), ({"source_url": "http://github.com/a"}, ""),
    ],
)
def test_first_rule_that_rejects(spark, changes, code):
    df = spark.createDataFrame([(1, json.dumps({**GOOD, **changes})), (2, None)], "position int, raw string")
    assert {r["position"]: r["rejection_code"] for r in source_records.rejections(df).collect()} == {1: code, 2: "unsupported_source_type"}


def _flat(value, path=""):
    for k, v in value.items():
        name = f"{path}.{k}" if path else k
        if isinstance(v, dict) and v:
            yield from _flat(v, name)
        else:
            yield name, v


def test_nested_usage_equals_a_plain_sum(spark):
    rng = random.Random(4)

    def made(depth):
        return {k: made(depth - 1) if depth and rng.random() < 0.3 else rng.choice([0, 5, 12, -1, True, 1.5, "3", None, [], {}]) if rng.random() < 0.2 else rng.randrange(100) for k in rng.sample("abcd", rng.randint(1, 3))}

    rows = [(rng.randrange(4), json.dumps(made(4))) for _ in range(200)] + [(1, None), (1, "{}"), (9, "[]")]
    totals, faults = usage.nested_usage(spark.createDataFrame(rows, "k int, raw string").repartition(3), "k", "raw")
    sums, bad, seen, inner = {}, {}, {}, set()
    for key, raw in rows:
        value = json.loads(raw) if raw else None
        if not isinstance(value, dict) or not value:
            bad[key, "", "empty"] = bad.get((key, "", "empty"), 0) + 1
            continue
        for path, v in _flat(value):
            seen[key, path] = seen.get((key, path), 0) + 1
            inner |= {(key, path[:k]) for k, c in enumerate(path) if c == "."}
            code = "not_a_count" if isinstance(v, bool) or not isinstance(v, int) else "negative" if v < 0 else None
            if code:
                bad[key, path, code] = bad.get((key, path, code), 0) + 1
            else:
                sums[key, path] = sums.get((key, path), 0) + v
    clash = {k for k in seen if k in inner}
    assert {(r["key"], r["path"]): r["total"] for r in totals.collect()} == {k: v for k, v in sums.items() if k not in clash}
    assert {(r["key"], r["path"], r["code"]): r["n"] for r in faults.collect()} == {**bad, **{(*k, "shape_conflict"): seen[k] for k in clash}} and clash
    empty = usage.nested_usage(spark.createDataFrame([], "k int, raw string"), "k", "raw")
    assert empty[0].count() == empty[1].count() == 0


def test_nested_usage_takes_records_apart_once(spark):
    rows = [(1, '{"a":{"b":1,"c":{"d":-2}}}'), (1, '{"a":5,"":3}'), (1, '{".z":1}'), (2, "null"), (2, '{"a.b":4,"a":{"b":true}}')]
    totals, faults = usage.nested_usage(spark.createDataFrame(rows, "k int, raw string"), "k", "raw")
    for df in (totals, faults):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    assert {tuple(r) for r in totals.collect()} == {(1, "a.b", 1), (1, ".z", 1), (2, "a.b", 4)}
    assert {tuple(r) for r in faults.collect()} == {(1, "a.c.d", "negative", 1), (1, "a", "shape_conflict", 1), (1, "", "shape_conflict", 1), (2, "", "empty", 1), (2, "a.b", "not_a_count", 1)}
