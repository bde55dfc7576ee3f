"""Report on a finished run and the gates of its release."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the gates, in their order.
GATES = (
    "exact_40_canonical_traces", "all_schema_valid_and_replayable", "infrastructure_failure_rate_at_most_5_percent", "zero_hidden_content_leaks", "zero_hard_verifier_bypasses",
    "independent_clean_reset_reproduction_verified", "all_successes_clean_reset_reproduced", "reproduction_counts_match_successes", "minimum_successes_met", "all_agent_token_budgets_respected",
    "all_agent_time_budgets_respected", "within_total_token_budget", "within_total_cost_budget", "within_total_time_budget", "immutable_usage_ledger_reconciled", "sft_hard_verified_and_reproduced",
    "minimum_sft_records_met", "minimum_rl_records_met", "minimum_preference_records_met", "preference_count_matches_positive_margin_eligibility", "export_counts_and_skip_reasons_recomputed",
    "preference_positive_margin", "human_review_passed", "review_quarantine_matches_exports",
)


@dataclass(frozen=True)
class Targets:
    """What a release asks for."""

    trajectories: int = 40
    infrastructure_share: float = 0.05
    successes: int = 1
    sft: int = 1
    rl: int = 1
    preference: int = 1
    run_tokens: int = 300_000
    run_seconds: float = 1200.0
    total_tokens: int = 12_000_000
    total_cost: str = "100"
    total_seconds: float = 172_800.0


def judged_runs(runs: DataFrame, leaks: DataFrame, bypasses: DataFrame, reproductions: DataFrame, targets: Targets) -> DataFrame:
    """Each run with what was found about it. runs: job_id, trace_id, scenario_id, termination_reason, reward, success, infrastructure_failure, tokens, elapsed_ms, semantic_hash.

    leaks, bypasses: trace_id of findings, repeats count once; reproductions: trace_id and reproduced, false if any says so. Null trace ids match nothing.
    """
    found = leaks.select("trace_id", F.lit(1).alias("leak"), F.lit(0).alias("bypass"), F.lit(None).cast("boolean").alias("again"))
    found = found.unionByName(bypasses.select("trace_id", F.lit(0).alias("leak"), F.lit(1).alias("bypass"), F.lit(None).cast("boolean").alias("again")))
    found = found.unionByName(reproductions.select("trace_id", F.lit(0).alias("leak"), F.lit(0).alias("bypass"), F.coalesce("reproduced", F.lit(False)).alias("again")))
    by = found.groupBy("trace_id").agg((F.max("leak") > 0).alias("leak"), (F.max("bypass") > 0).alias("bypass"), F.min("again").alias("again"))
    met = runs.join(by, "trace_id", "left")
    success = F.coalesce("success", F.lit(False))
    return met.withColumns(
        {
            "success": success,
            "termination_reason": F.coalesce("termination_reason", F.lit("missing")),
            "leak": F.coalesce("leak", F.lit(False)),
            "bypass": F.coalesce("bypass", F.lit(False)),
            "reproduced": F.coalesce("again", F.lit(False)),
            "unreproduced": success & ~F.coalesce("again", F.lit(False)),
            "over_tokens": F.coalesce(F.col("tokens") > targets.run_tokens, F.lit(False)),
            "over_time": F.coalesce(F.col("elapsed_ms") > targets.run_seconds * 1000, F.lit(False)),
        }
    ).drop("again")


def finding_ids(judged: DataFrame, contracted: DataFrame, jobs: DataFrame) -> DataFrame:
    """finding and id: traces with each finding, and contracted jobs that failed for the infrastructure."""
    kinds = {"leak": "leak", "bypass": "hard_bypass", "unreproduced": "unreproduced_success", "over_tokens": "agent_token_budget", "over_time": "agent_time_budget"}
    each = judged.select("trace_id", F.explode(F.array_compact(F.array(*[F.when(F.col(c), F.lit(k)) for c, k in kinds.items()]))).alias("finding"))
    failed = jobs.where("status = 'infrastructure_failed'").select("job_id").distinct().join(contracted.select("job_id").distinct(), "job_id", "left_semi")
    return each.select("finding", F.col("trace_id").alias("id")).distinct().unionByName(failed.select(F.lit("infrastructure").alias("finding"), F.col("job_id").alias("id")))


def count_maps(judged: DataFrame, tools: DataFrame) -> DataFrame:
    """dimension (termination, reward, tool), label and n. tools: trace_id and tool of each request; a null name is unknown; requests of other traces do not count."""
    sides = F.array(F.struct(F.lit("termination").alias("dimension"), F.col("termination_reason").alias("label")), F.struct(F.lit("reward").alias("dimension"), F.col("reward").cast("string").alias("label")))
    own = judged.select(F.explode(sides).alias("x")).groupBy("x.dimension", "x.label").agg(F.count("*").alias("n"))
    asked = tools.groupBy("trace_id", F.coalesce("tool", F.lit("unknown")).alias("label")).agg(F.count("*").alias("c"))
    used = asked.join(judged.select("trace_id").distinct(), "trace_id", "left_semi").groupBy("label").agg(F.sum("c").alias("n"))
    return own.unionByName(used.select(F.lit("tool").alias("dimension"), "label", "n"))


def margin_scenarios(judged: DataFrame, quarantined: DataFrame) -> DataFrame:
    """scenario_id of those with two runs, neither quarantined nor failed for the infrastructure, whose rewards differ."""
    out = quarantined.select("trace_id").distinct().withColumn("_q", F.lit(True))
    fine = F.col("_q").isNull() & ~F.coalesce("infrastructure_failure", F.lit(False))
    by = judged.join(out, "trace_id", "left").groupBy("scenario_id").agg(F.count("*").alias("n"), F.count(F.when(fine, 1)).alias("fine"), F.min("reward").alias("low"), F.max("reward").alias("high"))
    return by.where("n = 2 and fine = 2 and low <> high").select("scenario_id")


def report(judged: DataFrame, contracted: DataFrame, jobs: DataFrame, ledger: DataFrame, ledger_issues: DataFrame, reproductions: DataFrame, reproduction: DataFrame, exports: DataFrame, export_quarantine: DataFrame, reviews: DataFrame, review_quarantine: DataFrame) -> DataFrame:
    """One row of all that the gates need; every side is aggregated where it lies, only single rows meet.

    contracted: job_id; jobs: job_id, status; ledger: job_id, tokens, cost, elapsed_ms; ledger_issues: a row each; reproduction: one row or none
    (independent, artifacts_valid, semantic_match, hash_match, required, reproductions, reproduced, executed); exports: name (analysis, rl, sft, preference), records and gate, a row per file, or none;
    reviews: passed, one row or none; the quarantines: trace_id. Cases: an absent side counts 0 and fails its gates.
    """

    def n(when: Column) -> Column:
        return F.count(F.when(when, 1))

    runs = judged.agg(
        F.count("*").alias("canonical"), n(F.col("success")).alias("successes"), n(F.col("leak")).alias("leaks"), n(F.col("bypass")).alias("bypasses"), n(F.col("unreproduced")).alias("unreproduced"),
        n(F.col("over_tokens")).alias("over_tokens"), n(F.col("over_time")).alias("over_time"),
        (F.count("trace_id") - F.count_distinct("trace_id")).alias("duplicate_traces"), (F.count("semantic_hash") - F.count_distinct("semantic_hash")).alias("semantic_duplicates"),
    )
    wanted = contracted.select("job_id").distinct()
    failed = jobs.where("status = 'infrastructure_failed'").select("job_id").distinct().join(wanted, "job_id", "left_semi").agg(F.count("*").alias("infrastructure"))
    used = ledger.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("total_tokens"),
        F.coalesce(F.sum(F.col("cost").cast("decimal(28,10)")), F.lit(0)).cast("decimal(28,10)").alias("total_cost"),
        (F.coalesce(F.sum(F.col("elapsed_ms").cast("decimal(28,6)")), F.lit(0)) / 1000).cast("decimal(28,6)").alias("total_seconds"),
    )
    again = reproductions.groupBy("trace_id").agg(F.min(F.coalesce("reproduced", F.lit(False))).alias("ok")).agg(F.count("*").alias("r_traces"), n(~F.col("ok")).alias("r_failed"))
    flags = ("independent", "artifacts_valid", "semantic_match", "hash_match")
    numbers = ("required", "reproductions", "reproduced", "executed")
    told = reproduction.agg(F.count("*").alias("r_given"), *[F.coalesce(F.min(F.coalesce(c, F.lit(False))), F.lit(False)).alias(f"r_{c}") for c in flags], *[F.coalesce(F.max(c), F.lit(-1)).cast("long").alias(f"r_{c}") for c in numbers])

    def of(name: str) -> list[Column]:
        own = F.col("name") == name
        return [F.coalesce(F.sum(F.when(own, F.col("records"))), F.lit(0)).cast("long").alias(f"x_{name}"), F.coalesce(F.min(F.when(own, F.coalesce("gate", F.lit(False)))), F.lit(False)).alias(f"g_{name}")]

    files = exports.agg(F.count("*").alias("x_given"), *[c for name in ("analysis", "rl", "sft", "preference") for c in of(name)])
    margins = margin_scenarios(judged, export_quarantine).agg(F.count("*").alias("eligible"))
    seen = reviews.agg(F.coalesce(F.min(F.coalesce("passed", F.lit(False))), F.lit(False)).alias("reviewed"))
    q, e = (d.select("trace_id").distinct().withColumn(c, F.lit(1)) for d, c in ((review_quarantine, "_r"), (export_quarantine, "_e")))
    apart = q.join(e, "trace_id", "full").agg(n(F.col("_r").isNull() | F.col("_e").isNull()).alias("quarantine_differs"))
    out = runs.join(F.broadcast(wanted.agg(F.count("*").alias("expected"))))
    for one in (failed, used, ledger_issues.agg(F.count("*").alias("ledger_issues")), again, told, files, margins, seen, apart):
        out = out.join(F.broadcast(one))  # one row each
    return out.withColumn("infrastructure_rate", F.when(F.col("expected") > 0, F.col("infrastructure") / F.col("expected")).otherwise(0.0)).withColumn("success_rate", F.when(F.col("canonical") > 0, F.col("successes") / F.col("canonical")).otherwise(0.0))


def gates(summary: DataFrame, targets: Targets) -> DataFrame:
    """gate and passed, a row for each of ``GATES``; summary: the row of ``report``."""
    c = F.col
    given, exported = c("r_given") > 0, c("x_given") > 0
    same = [c(f"r_{k}") == c("successes") for k in ("required", "reproductions", "reproduced", "executed")]
    checks = (
        (c("canonical") == c("expected")) & (c("expected") == targets.trajectories),
        c("canonical") == c("expected"),
        c("infrastructure_rate") <= targets.infrastructure_share,
        c("leaks") == 0,
        c("bypasses") == 0,
        given & c("r_independent") & c("r_artifacts_valid") & c("r_semantic_match") & c("r_hash_match"),
        given & (c("r_traces") == c("successes")) & (c("r_failed") == 0) & (c("unreproduced") == 0),
        given & same[0] & same[1] & same[2] & same[3],
        c("successes") >= targets.successes,
        c("over_tokens") == 0,
        c("over_time") == 0,
        c("total_tokens") <= targets.total_tokens,
        c("total_cost") <= F.lit(targets.total_cost).cast("decimal(28,10)"),
        c("total_seconds") <= F.lit(str(targets.total_seconds)).cast("decimal(28,6)"),
        c("ledger_issues") == 0,
        c("g_sft"),
        c("x_sft") >= targets.sft,
        c("x_rl") >= targets.rl,
        c("x_preference") >= targets.preference,
        exported & (c("x_preference") == c("eligible")),
        exported,
        c("g_preference"),
        c("reviewed"),
        c("reviewed") & exported & (c("quarantine_differs") == 0),
    )
    each = F.array(*[F.struct(F.lit(k).cast("int").alias("position"), F.lit(name).alias("gate"), F.coalesce(check, F.lit(False)).alias("passed")) for k, (name, check) in enumerate(zip(GATES, checks, strict=True))])
    return summary.select(F.explode(each).alias("x")).select("x.position", "x.gate", "x.passed")
