"""Evaluation records: public projections, bypass and reproduction checks, state requirements, leaks and simulated users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.ids import canonical_json


def public_metrics(c: Column, names: tuple[str, ...]) -> Column:
    """The metrics whose names are public."""
    return F.map_filter(c, lambda k, v: k.isin(*names) & v.isNotNull() & ~F.isnan(v))


def metrics_digest(metrics: Column) -> Column:
    """SHA-256 of the canonical JSON of all metrics, so that what is left out is bound as well."""
    return F.sha2(canonical_json(F.to_json(metrics)), 256)


def public_results(results: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """Results fit for export: unknown evaluators by digest, general reasons, the reason's digest and size."""
    name = F.when(F.col("verifier").isin(*known), F.col("verifier")).otherwise(F.concat(F.lit("custom_evaluator_"), F.substring(F.sha2("verifier", 256), 1, 16)))
    return results.select("job_id", "position", name.alias("evaluator"), "passed", F.when(F.col("passed"), "passed").otherwise("failed").alias("reason"), F.sha2("reason", 256).alias("reason_sha256"), F.octet_length("reason").cast("long").alias("reason_bytes"))


def bypassed(results: DataFrame, expected: list[str]) -> DataFrame:
    """Jobs whose evaluators are not the expected ones in order, or that claim success against a failed one."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", "verifier"))), lambda x: x["verifier"])
    grouped = results.groupBy("job_id").agg(F.array_join(ordered, ",").alias("names"), F.bool_or("claimed").alias("claimed"), F.bool_and(F.col("passed") & ~F.col("infra")).alias("fine"))
    return grouped.select("job_id", ((F.col("names") != ",".join(expected)) | (F.col("claimed") & ~F.col("fine"))).alias("bypassed"))


def preconditions(traces: DataFrame, reports: DataFrame) -> DataFrame:
    """What keeps a session from export: no report, not finished, success or verifier count that disagree."""
    met = traces.join(reports, "session_id", "left")
    codes = F.array_compact(
        F.array(
            F.when(F.col("report_success").isNull(), "no_report"),
            F.when(~F.col("finished"), "not_finished"),
            F.when(F.col("report_success") != F.col("success"), "success_differs"),
            F.when(F.col("report_results") != F.col("results"), "results_differ"),
        )
    )
    return met.select("session_id", F.array_join(codes, ",").alias("codes"))


def reproduced(first: DataFrame, again: DataFrame) -> DataFrame:
    """Per job whether the results of a second run have the same signature."""

    def signature(df: DataFrame, name: str) -> DataFrame:
        step = F.concat_ws("|", "verifier", F.col("passed").cast("string"), F.col("infra").cast("string"))
        ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", step.alias("s")))), lambda x: x["s"]), ";")
        return df.groupBy("job_id").agg(ordered.alias(name))

    met = signature(first, "a").join(signature(again, "b"), "job_id", "left")
    return met.select("job_id", F.when(F.col("b").isNull(), "missing").when(F.col("a") == F.col("b"), "reproduced").otherwise("different").alias("outcome"))


def state_checks(required: DataFrame, files: DataFrame) -> DataFrame:
    """Requirements on files: kind "equals" or "contains"; a missing file fails."""
    met = required.join(files, "path", "left")
    fine = F.when(F.col("content").isNull(), False).when(F.col("kind") == "equals", F.col("content") == F.col("expected")).otherwise(F.contains("content", "expected"))
    return met.select("path", "kind", fine.alias("passed"))


def requirement_met(text: Column, requirement: str) -> Column:
    """A requirement is met by its words: as they stand, or all longer than two letters somewhere."""
    plain = F.regexp_replace(F.lower(text), r"\s+", " ")
    words = [w for w in requirement.lower().split() if len(w) > 2]
    each = F.lit(bool(words))
    for w in words:
        each = each & plain.contains(w)
    return plain.contains(" ".join(requirement.lower().split())) | each


def hidden_leaks(events: DataFrame, secrets: DataFrame, least: int = 8) -> DataFrame:
    """Secrets of a session (long enough, not public anyway) that its events show: session_id, secret_sha256, events.

    Equality of the session comes first; containment is only tested within it.
    """
    kept = secrets.where((F.length("secret") >= least) & ~F.contains("public_text", "secret"))
    met = events.join(kept, "session_id").where(F.contains("content", "secret"))
    return met.groupBy("session_id", F.sha2("secret", 256).alias("secret_sha256")).agg(F.count("*").alias("events"))


def simulated_action(question: Column, turn: Column, patience: int, corrections: list[str], known: list[str], unavailable: list[str]) -> Column:
    """What a rule-based user answers: stop, correct, clarify, refuse, confirm, else refuse."""
    q = F.lower(question)

    def named(topics: list[str]) -> Column:
        hit = F.lit(False)
        for t in topics:
            hit = hit | q.contains(t.lower()) | q.contains(t.lower().replace("_", " "))
        return hit

    return F.when(turn > patience, "stop").when(named(corrections), "correct").when(named(known), "clarify").when(named(unavailable), "refuse").when(q.contains("confirm") | q.contains("proceed"), "confirm").otherwise("refuse")


def rule_rows(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key and code of every rule that does not hold."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), code) for code, ok in rules.items()]))
    return rows.select(key, F.explode(failed).alias("code"))
