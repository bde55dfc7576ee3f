"""Small fixtures whose results are worked out by hand, and properties against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from trajlake.functions import ids
from trajlake.operators import corpus, jobs, records, review, selection, similar_sets, traces, usage

JOB = "job_id string, scenario_id string, status string, success int, tokens long, goal_type string, trace_id string, attempts int, metrics map<string,double>"


def _jobs(spark, rows):
    return spark.createDataFrame(rows, JOB)


def test_quality_report_counts_missing_metrics_as_zero(spark):
    rows = [("a", "s1", "completed", 1, 10, "refund", "t1", 1, {"goal_alignment": 1.0}), ("b", "s1", "failed", 0, 5, "refund", "t1", 1, {"goal_alignment": 0.5, "x": 4.0}), ("c", "", "pending", 0, None, "", "", 0, {})]
    r = jobs.quality_report(_jobs(spark, rows)).first()
    assert (r["rollouts"], r["scenario_count"], r["successes"], r["duplicate_traces"]) == (3, 1, 1, 1)
    assert r["pass_at_observed_k"] == 0.5 and r["in_group_reward_std_mean"] == 0.5
    means = {x["metric"]: x["average"] for x in jobs.metric_averages(_jobs(spark, rows)).collect()}
    assert means == {"goal_alignment": 0.5, "x": round(4 / 3, 6)}


def test_quality_report_of_nothing_is_zero(spark):
    r = jobs.quality_report(_jobs(spark, [])).first()
    assert r["rollouts"] == 0 and r["success_rate"] == 0.0 and r["pass_at_observed_k"] == 0.0


def test_budget_stops_at_the_first_job_that_does_not_fit(spark):
    rows = [(f"j{k}", "s", "pending", 0, t, "", "", 0, {}) for k, t in enumerate([40, 50, 30, 1])]
    assert [r["job_id"] for r in jobs.budget_prefix(_jobs(spark, rows), 100).orderBy("position").collect()] == ["j0", "j1"]


def test_numbering_equals_a_sort(spark):
    ids = [f"{random.Random(k).random():.6f}" for k in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    assert [r["id"] for r in jobs.numbered(df, "id").orderBy("rn").collect()] == sorted(ids)


@pytest.mark.parametrize("advisory", ["64m", "1m"])
def test_numbering_of_many_partitions(spark, advisory):
    """Whatever partitions the planner makes, no row is lost and none has another's number."""
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory, "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "23"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(1_500_000).select(F.format_string("job_%08d", "id").alias("job_id"), "id", F.repeat(F.lit("x"), 100).alias("pad"), F.lit(2).alias("tokens")).repartition(13)
        r = jobs.numbered(df, "job_id").agg(F.count("*"), F.sum((F.col("rn") != F.col("id") + 1).cast("int"))).first()
        assert tuple(r) == (1_500_000, 0)
        admitted = jobs.budget_prefix(df, 1_000_001).agg(F.count("*"), F.max("used"), F.max("position")).first()
        assert tuple(admitted) == (500_000, 1_000_000, 500_000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_numbering_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "id string")
    assert {r["id"]: r["rn"] for r in jobs.numbered(df, "id").collect()} == {None: 1, "a": 2, "b": 3}
    assert jobs.numbered(df.where("false"), "id").count() == 0


def test_usage_decrease_is_found(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 3, 7), ("b", 1, -1)], "job_id string, position int, total long")
    assert {(r["job_id"], r["position"]) for r in usage_rows(df)} == {("a", 3), ("b", 1)}


def usage_rows(df):
    return jobs.usage_decreases(df).collect()


def test_decimal_cost_is_exact(spark):
    df = spark.createDataFrame([("a", 1000, 400, 10), ("a", 1, 5, 0)], "job_id string, prompt_tokens long, cached_tokens long, completion_tokens long")
    r = usage.cost_by_job(df, "3.00", "0.30", "15.00").first()
    assert r["cached_tokens"] == 401 and r["cost_usd"] == round((600 * 3 + 401 * 0.3 + 150) / 1e6, 8)


def test_similar_token_sets_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(rng.sample(words, rng.randint(1, 12))) for _ in range(120)] + ["", "12 34"]
    df = spark.createDataFrame([(f"s{k:03d}", t) for k, t in enumerate(texts)], "seed_id string, query string")
    sets = {}
    for k, t in enumerate(texts):
        s = frozenset(w for w in t.split() if not w.isdigit())
        if s:
            sets.setdefault(s, f"s{k:03d}")
    want = set()
    for a, i in sets.items():
        for b, j in sets.items():
            if i < j and 10 * len(a & b) >= 8 * len(a | b):
                want.add((i, j))
    assert {(r["left_id"], r["right_id"]) for r in corpus.semantic_duplicates(df).collect()} == want


def test_contamination_ignores_blank_keys_and_itself(spark):
    df = spark.createDataFrame([("a", "x", True), ("b", "x", False), ("c", "", True), ("d", "", False)], "seed_id string, k string, train_eligible boolean")
    found = corpus.contamination(df, df, {"k": F.col("k")}).collect()
    assert [(r["seed_id"], r["matches"]) for r in found] == [("a", 1)]


def test_round_robin_equals_a_loop(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), k) for k in range(40)]
    got = [(r["b"], r["p"]) for r in corpus.round_robin(spark.createDataFrame(rows, "b string, p int"), ["b"], "p", 17).orderBy("turn", "b").collect()]
    buckets = {b: [r for r in rows if r[0] == b] for b in sorted({r[0] for r in rows})}
    want = []
    while len(want) < 17:
        for b in buckets:
            if buckets[b] and len(want) < 17:
                want.append(buckets[b].pop(0))
    assert got == want


def test_passages_are_found_where_they_begin_inside_a_word(spark):
    passage = "ne two three four five six seven eight nine ten eleven"
    texts = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "two three"), (3, None)], "text_id long, text string")
    values = spark.createDataFrame([(7, passage)], "value_id long, value string")
    assert [(r["value_id"], r["text_id"]) for r in corpus.passage_leaks(values, texts).collect()] == [(7, 1)]


def test_values_of_few_words_are_found_as_a_plain_search_finds_them(spark):
    rng = random.Random(3)
    texts = [(k, "".join(rng.choice(["ab", "b", "c", "é", " ", "\n", "aab "]) for _ in range(rng.randrange(60)))) for k in range(40)]
    texts += [(40, None), (41, ""), (42, "x" * 250 + "needle-of-a-leak" + "y" * 300), (43, "see tests/hidden/test_a.py:3"), (44, "12 33 45 6")]
    values = ["", " ", " \n", "a", "ab", "b c", "ab ", " b", "  c", "ab b\nc", "needle-of-a-leak", "tests/hidden/test_a.py", "2 33 45 6", "2 33 46 6", "b ab aab b c ab b aab b", "nowhere", None]
    values += [t[i : i + n] for _, t in texts[:40] for i, n in [(rng.randrange(30), rng.randrange(1, 25))]]
    rows = list(enumerate(values)) + [(0, "needle-of-a-leak")]
    got = corpus.passage_leaks(spark.createDataFrame(rows, "value_id long, value string"), spark.createDataFrame(texts, "text_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted((v, t) for v, x in rows for t, y in texts if x is not None and y is not None and x in y)


def test_fragments_of_hidden_values(spark):
    value = f"run src/app/test_hidden.py with my_secret_key and {'a' * 64} not {'b' * 65} or a/b"
    got = corpus.sensitive_fragments(spark.createDataFrame([(1, value), (2, None)], "value_id long, value string")).collect()
    assert sorted(map(tuple, got)) == [(1, "a" * 64), (1, "my_secret_key"), (1, "src/app/test_hidden.py"), (1, "test_hidden.py")]


def test_last_allowlist_entry_wins(spark):
    r = spark.createDataFrame([(1, "repo", "MIT")], "position long, repository string, license string")
    a = spark.createDataFrame([("repo", "GPL-3.0", 1), ("repo", "MIT", 2)], "repository string, license string, position long")
    assert records.allowlist_filter(r, a).first()["reason"] == ""


def test_only_warnings_may_be_waived(spark):
    f = spark.createDataFrame([("c", "1", "warning"), ("c", "2", "error"), ("c", "3", "warning")], "code string, entry string, severity string")
    d = spark.createDataFrame([("c", "1"), ("c", "2"), ("c", "9")], "code string, entry string")
    assert {r["entry"]: r["outcome"] for r in records.waivers(f, d).collect()} == {"1": "waived", "2": "not_waivable", "3": "open", "9": "unmatched_waiver"}


TRACE = "session_id string, sequence int, event_id string, event_type string, call_id string, tool string, tool_status string, decision string, content string"


def test_turn_rewards_by_hand(spark):
    rows = [
        ("s", 0, "e0", "model_response", "", None, None, None, "hi"),
        ("s", 1, "e1", "tool_requested", "c1", "ask_user", None, None, None),
        ("s", 2, "e2", "tool_finished", "c1", None, "completed", None, None),
        ("s", 3, "e3", "model_response", "", None, None, None, ""),
        ("s", 4, "e4", "policy_decision", "c9", None, None, "deny", None),
        ("s", 5, "e5", "tool_finished", "c7", None, "failed", None, None),
    ]
    got = {r["event_id"]: (r["turn_index"], r["action_type"], r["reward"]) for r in traces.turn_rewards(spark.createDataFrame(rows, TRACE)).collect()}
    assert got == {"e1": (0, "ask_user", 0.2), "e2": (0, "ask_user", 0.1), "e4": (1, "tool_call", -1.0), "e5": (1, "tool_call", -0.1)}


def test_order_rules_equal_a_loop(spark):
    rng = random.Random(11)
    rows = []
    for s in range(60):
        for k in range(rng.randint(1, 14)):
            kind = rng.choice(["model_response", "tool_requested", "tool_finished"])
            rows.append((f"s{s}", k, f"e{s}-{k}", kind, "" if kind == "model_response" else rng.choice(["a", "b", "c"]), "t", "completed", None, "x"))
    bad = set()
    for s in {r[0] for r in rows}:
        asked, done, open_calls = set(), set(), 0
        for r in [r for r in rows if r[0] == s]:
            if r[3] == "tool_requested":
                if r[4] in asked:
                    bad.add(s)
                asked.add(r[4])
                open_calls += 1
            elif r[3] == "tool_finished":
                if r[4] in done or r[4] not in asked:
                    bad.add(s)
                done.add(r[4])
                open_calls -= 1
            elif open_calls:
                bad.add(s)
    got = {r["session_id"] for r in traces.order_violations(spark.createDataFrame(rows, TRACE)).collect()}
    assert got == bad


def test_risk_of_an_unknown_reason_is_ten(spark):
    df = spark.createDataFrame([("t", ["odd"], False, "max_turns", 3)], "trace_id string, flags array<string>, success boolean, termination string, declared long")
    assert review.risk(df).first()["risk_score"] == 3 + 10 + 75 + 40


def test_gate_needs_every_decision(spark):
    want = spark.createDataFrame([("a",), ("b",)], "trace_id string")
    got = spark.createDataFrame([("a", "acceptable", False), ("c", "acceptable", False)], "trace_id string, verdict string, quarantine boolean")
    r = review.gate(want, got, 0.5).first()
    assert (r["missing"], r["unexpected"], r["acceptable_rate"], r["passed"]) == (1, 1, 0.5, False)


def _greedy(rows, target, caps):
    counts = {c: {} for c in caps}
    left, out = sorted(rows, key=lambda r: r["seed_id"]), []
    while len(out) < target:
        best = None
        for r in left:
            if any(s < 1 and counts[c].get(r[c], 0) + 1 > int(target * s) for c, s in caps.items()):
                continue
            rank = (*[0.0 if s >= 1 else counts[c].get(r[c], 0) / max(1, int(target * s)) for c, s in caps.items()], r["seed_id"])
            if best is None or rank < best[0]:
                best = (rank, r)
        if best is None:
            break
        out.append(best[1]["seed_id"])
        left.remove(best[1])
        for c in caps:
            counts[c][best[1][c]] = counts[c].get(best[1][c], 0) + 1
    return out


def test_greedy_selection_equals_a_loop(spark):
    rng = random.Random(2)
    rows = [{"seed_id": f"s{k:03d}", "family": rng.choice("abcd"), "method": rng.choice("xy"), "repo": rng.choice("mnopqr")} for k in range(150)]
    caps = {"family": 0.3, "method": 1.0, "repo": 0.25}
    got = selection.balanced(spark.createDataFrame(rows), 40, caps)
    assert {r["seed_id"] for r in got.collect()} == set(_greedy(rows, 40, caps))


def test_greedy_choices_beyond_the_combinations_that_fit(spark, monkeypatch):
    monkeypatch.setattr(selection, "MOST_COMBINATIONS", 3)
    rng = random.Random(12)
    for head in (1, 6, 1000):
        monkeypatch.setattr(selection, "HEAD_ROWS", head)
        rows = [{"seed_id": f"s{k:03d}", "family": rng.choice(["a", "b", "c", None]), "method": rng.choice("xy"), "repo": rng.choice("mnopqr")} for k in range(60)]
        caps = {"family": 0.4, "method": 1.0, "repo": 0.25}
        got = selection.balanced(spark.createDataFrame(rows), 14, caps)
        assert sorted(r["seed_id"] for r in got.collect()) == sorted(_greedy(rows, 14, caps)) and got.columns == ["family", "method", "repo", "seed_id"]
        marks = [{"trace_id": f"t{k:03d}", "scenario_id": rng.choice(["a", "b", "c", "d", None]), "success": rng.random() < 0.5, "risk_score": rng.choice([0, 40, 75, 1000])} for k in range(40)]
        few = selection.covering(spark.createDataFrame(marks), 13, ["scenario_id", "success"]).orderBy("position").collect()
        with monkeypatch.context() as m:
            m.setattr(selection, "MOST_COMBINATIONS", 1000)
            want = selection.covering(spark.createDataFrame(marks), 13, ["scenario_id", "success"]).orderBy("position").collect()
        assert [r["trace_id"] for r in few] == [r["trace_id"] for r in want]
    assert selection.balanced(spark.createDataFrame(rows), 200, caps).count() == len(_greedy(rows, 200, caps))


def test_greedy_review_equals_a_loop(spark):
    rng = random.Random(7)
    rows = [{"trace_id": f"t{k:03d}", "scenario_id": rng.choice("abcdefgh"), "success": rng.random() < 0.5, "risk_score": rng.choice([0, 40, 75, 1000, 1075])} for k in range(80)]
    columns = ["scenario_id", "success"]
    chosen = sorted((r for r in rows if r["risk_score"] >= 1000), key=lambda r: (-r["risk_score"], r["trace_id"]))[:12]
    while len(chosen) < 12:
        left = [r for r in rows if r not in chosen]
        chosen.append(min(left, key=lambda r: (*[-(r[c] not in {x[c] for x in chosen}) for c in columns], -r["risk_score"], r["trace_id"])))
    got = selection.covering(spark.createDataFrame(rows), 12, columns).orderBy("position").collect()
    assert [r["trace_id"] for r in got] == [r["trace_id"] for r in chosen]


def test_content_ids_follow_canonical_json(spark):
    df = spark.createDataFrame([('{"b": 1.0, "a": "é"}',), ("no json",), (None,)], "raw string")
    got = [r[0] for r in df.select(ids.canonical_json(F.col("raw"))).collect()]
    assert got == ['{"a":"\\u00e9","b":1.0}', None, None]


def test_every_scenario_gets_its_assignments(spark, tmp_path):
    from trajlake.plans.record_queries import rollout_assignments

    spark.createDataFrame([(k,) for k in (3, 499, 500, 70_001)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    got = rollout_assignments(spark, str(tmp_path)).collect()
    assert sorted((r["scenario_id"], r["rollout_index"]) for r in got) == sorted((f"c_{k}", i) for k in (3, 499, 500, 70_001) for i in (0, 1))
    assert len({r["job_id"] for r in got}) == 8


def test_review_seal_names_every_change(spark):
    summaries = [(f"t{k}", f"s{k % 3}", ["odd"] if k % 2 else [], k % 4 != 0, "success", k % 5) for k in range(12)]
    scored = review.risk(spark.createDataFrame(summaries, "trace_id string, scenario_id string, flags array<string>, success boolean, termination string, declared int"))
    queue = review.sealed(review.queue(scored, 6).select("trace_id", "scenario_id", "reasons", "risk_score", "position")).cache()
    seal = review.seal(queue)
    assert review.seal_violations(queue, seal, scored, 6).collect() == [] and seal.first()["items"] == 6
    ids = [r["trace_id"] for r in queue.orderBy("position").collect()]
    at = F.col("position")
    forged = review.sealed(queue.withColumn("risk_score", F.col("risk_score") + F.when(at == 1, 5).otherwise(0)).drop("item_sha256"))  # hashes made to fit
    assert {tuple(r) for r in review.seal_violations(forged, review.seal(forged), scored, 6).collect()} == {(ids[1], "risk_score")}
    assert {tuple(r) for r in review.seal_violations(forged, seal, scored, 6).collect()} == {(ids[1], "risk_score"), (None, "queue_sha256")}
    lazy = queue.withColumn("reasons", F.when(at == 2, F.array(F.lit("calm"))).otherwise(F.col("reasons")))  # hashes left as they were
    assert {tuple(r) for r in review.seal_violations(lazy, seal, scored, 6).collect()} == {(ids[2], "item_sha256"), (ids[2], "reasons"), (None, "queue_sha256")}
    fewer = queue.where(at != 4)
    assert {tuple(r) for r in review.seal_violations(fewer, seal, scored, 6).collect()} == {(ids[4], "missing"), (None, "items"), (None, "queue_sha256")}
    assert {tuple(r) for r in review.seal_violations(queue, seal.limit(0), scored, 6).collect()} == {(None, "items"), (None, "queue_sha256")}
    none = queue.limit(0)
    assert review.seal(none).collect() == [] and review.seal_violations(none, review.seal(none), scored.limit(0), 6).collect() == []


def test_semantic_duplicates_of_long_sets_with_any_known_frequencies(spark):
    """Sets of up to 400 tokens, of which several shared ones are asked for; one order of tokens is as good as another."""
    rng = random.Random(11)
    words = ["w" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    sets = [set(rng.sample(words, rng.choice([1, 3, 40, 63, 64, 130, 400]))) for _ in range(60)]
    for k in range(60):  # near ones on both sides of the limit
        odd = rng.randint(0, max(1, len(sets[k]) // 4))
        sets.append(set(sorted(sets[k])[odd:]) | set(rng.sample(words, rng.randint(0, odd // 2 + 1))))
    rows = [(f"s{k:04d}", " ".join(s)) for k, s in enumerate(sets) if s]
    first = {}
    for name, text in rows:
        first.setdefault(frozenset(text.split()), name)
    want = {(a, b): round(len(x & y) / len(x | y), 6) for x, a in first.items() for y, b in first.items() if a < b and 10 * len(x & y) >= 8 * len(x | y)}
    df = spark.createDataFrame(rows, "seed_id string, query string").repartition(3)
    for known in (corpus.KNOWN, 50, 0):
        assert {(r["left_id"], r["right_id"]): r["jaccard"] for r in corpus.semantic_duplicates(df, known=known).collect()} == want
    assert 20 < len(want) < 60


def _near_by_brute_force(rows):
    first = {}
    for name, text in sorted(rows):
        first.setdefault(frozenset(text.split()), name)
    sets = sorted((name, x) for x, name in first.items())
    return {(a, b): round(len(x & y) / len(x | y), 6) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if 10 * len(x & y) >= 8 * len(x | y)}


def test_semantic_duplicates_pass_on_no_pairs_of_near_copies(spark, monkeypatch):
    """400 near copies of one text make 79,800 pairs; what is shuffled to find them grows with the copies."""
    monkeypatch.setattr(similar_sets, "BLOCK", 150)  # several blocks
    rng = random.Random(5)
    base = [f"w{k}" for k in range(80)]
    rows = [(f"s{k:04d}", " ".join([*base[: 80 - k % 3], f"x{k}"])) for k in range(400)] + [(f"t{k:04d}", " ".join(f"y{rng.randrange(200)}" for _ in range(9))) for k in range(100)]
    df = spark.createDataFrame(rows, "seed_id string, query string").repartition(3)
    jvm, store = spark._jvm, spark._jsc.sc().statusStore()

    def shuffled():
        stages = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = shuffled()
    found = {(r["left_id"], r["right_id"]): r["jaccard"] for r in corpus.semantic_duplicates(df).collect()}
    assert found == _near_by_brute_force(rows) and len(found) >= 79_800
    assert shuffled() - before < 40_000


def test_semantic_duplicates_of_sets_with_signatures_of_several_widths(spark):
    rng = random.Random(6)
    rows = []
    for n in (880, 910, 1780, 1830, 3700):
        words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        for k, off in enumerate((0, 20, n // 10, n // 5 - 1, n // 5 + 1)):  # the last is too far from the first
            rows.append((f"s{n}{k}", " ".join(words[off:])))
            rows.append((f"t{n}{k}", " ".join([*words, *(f"z{k}x{j}" for j in range(off * 5 // 4))])))
    df = spark.createDataFrame(rows, "seed_id string, query string").repartition(2)
    want = _near_by_brute_force(rows)
    assert {(r["left_id"], r["right_id"]): r["jaccard"] for r in corpus.semantic_duplicates(df).collect()} == want and len(want) > 40


def test_semantic_duplicates_tokens_of_odd_texts(spark):
    """Tokens end at any other byte and at the text's end; pure numbers, empty and null texts hold none; upper case is lowered."""
    rows = [("a", "x1\u00e9Y2, 33 z4\u4e2dq 7w"), ("b", "x1 y2 z4 q 7w n5"), ("c", None), ("d", ""), ("e", "12 34"), ("f", "7W-Q_z4.Y2+x1"), ("g", "33"), ("h", "\u00e9")]
    df = spark.createDataFrame(rows, "seed_id string, query string").coalesce(1)
    assert [tuple(r) for r in corpus.semantic_duplicates(df).collect()] == [("a", "b", 0.833333)]
    assert corpus.semantic_duplicates(df.limit(0)).collect() == []


def test_semantic_duplicates_of_seeds_that_stand_twice(spark):
    df = spark.createDataFrame([("a", "p q r s t"), ("b", "p q r s t u"), ("a", "p q r s t"), ("b", "p q r s t u"), ("c", "p q r s t")], "seed_id string, query string").repartition(3)
    assert [tuple(r) for r in corpus.semantic_duplicates(df).collect()] == [("a", "b", 0.833333)]
