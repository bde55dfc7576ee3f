"""Views of finished runs for training and analysis, their manifest, and its check against the runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.digests import ordered_digests

VIEWS = ("analysis", "rl", "sft", "preference")


def _flags(runs: DataFrame, quarantined: DataFrame, reproduced: DataFrame) -> DataFrame:
    q = quarantined.select("trace_id").distinct().withColumn("quarantined", F.lit(True))
    r = reproduced.groupBy("trace_id").agg(F.min(F.coalesce("reproduced", F.lit(False))).alias("reproduced"))
    out = runs.join(q, "trace_id", "left").join(r, "trace_id", "left")
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("quarantined", "reproduced", "success", "infrastructure_failure")}
    return out.withColumns(flags)


def _pairs(flagged: DataFrame) -> DataFrame:
    """Per scenario: runs, those that may be compared, the better and the worse of them."""
    fine = ~F.col("quarantined") & ~F.col("infrastructure_failure")
    run = F.when(fine, F.struct("reward", "trace_id"))
    return flagged.groupBy("scenario_id").agg(F.count("*").alias("runs"), F.count(run).alias("fine"), F.max(run).alias("best"), F.min(run).alias("worst"))


def export_records(runs: DataFrame, quarantined: DataFrame, reproduced: DataFrame) -> DataFrame:
    """view, record_id and line of every record that is exported.

    runs: trace_id (distinct), scenario_id, reward, success, infrastructure_failure and the lines of its views: analysis,
    rl, sft. All runs are analysed; episodes take those neither quarantined nor failed for the infrastructure, fine-tuning of these
    the successes that a clean reset reproduced; a scenario of two such runs with unlike rewards gives a preference.
    """
    f = _flags(runs, quarantined, reproduced)
    usable = ~F.col("quarantined") & ~F.col("infrastructure_failure")
    views = F.array(
        F.struct(F.lit("analysis").alias("view"), F.col("analysis").alias("line")),
        *[F.when(when, F.struct(F.lit(v).alias("view"), F.col(v).alias("line"))) for v, when in (("rl", usable), ("sft", usable & F.col("success") & F.col("reproduced")))],
    )
    own = f.select(F.col("trace_id").alias("record_id"), F.explode(F.array_compact(views)).alias("x")).select("x.view", "record_id", "x.line")
    good = _pairs(f).where("runs = 2 and fine = 2 and best.reward > worst.reward")
    name = F.concat(F.lit("preference_"), F.col("best.trace_id"), F.lit("_"), F.col("worst.trace_id"))
    line = F.to_json(F.struct(F.col("best.trace_id").alias("chosen_trace_id"), name.alias("id"), (F.col("best.reward") - F.col("worst.reward")).alias("margin"), F.col("worst.trace_id").alias("rejected_trace_id"), "scenario_id"))
    return own.unionByName(good.select(F.lit("preference").alias("view"), name.alias("record_id"), line.alias("line")))


def export_skips(runs: DataFrame, quarantined: DataFrame, reproduced: DataFrame) -> DataFrame:
    """reason and n: runs left out of episodes or fine-tuning, and scenarios without a preference, each by its first reason."""
    f = _flags(runs, quarantined, reproduced)
    run = F.when(F.col("quarantined"), "quarantined").when(F.col("infrastructure_failure"), "infrastructure_failure").when(F.col("success") & ~F.col("reproduced"), "success_not_reproduced")
    pair = F.when(F.col("runs") != 2, "preference_not_two_runs").when(F.col("fine") != 2, "preference_ineligible").when(F.col("best.reward") <= F.col("worst.reward"), "preference_tie")
    both = f.select(run.alias("reason")).unionByName(_pairs(f).select(pair.alias("reason")))
    return both.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def manifest(records: DataFrame) -> DataFrame:
    """view, records and sha256 of its lines in order of their ids, each with a line end; a view without records has a row too."""
    made = ordered_digests(records.withColumn("_line", F.concat("line", F.lit("\n"))), F.col("view"), F.col("record_id"), F.col("_line"), joint="")
    every = records.sparkSession.createDataFrame([(v,) for v in VIEWS], "view string")
    empty = F.sha2(F.lit(""), 256)
    return every.join(made, F.col("view") == F.col("key"), "left").select("view", F.coalesce("n", F.lit(0)).alias("records"), F.coalesce("sha256", empty).alias("sha256"))


def manifest_differences(declared: DataFrame, recomputed: DataFrame) -> DataFrame:
    """view and code where a declared manifest is not what the runs give: missing, unexpected, doubled, records or sha256."""
    d = declared.groupBy("view").agg(F.count("*").alias("_n"), F.min("records").alias("_records"), F.min("sha256").alias("_sha256"))
    met = d.join(recomputed, "view", "full")

    def unlike(c: str) -> Column:
        return ~F.col(f"_{c}").eqNullSafe(F.col(c))

    codes = F.when(F.col("_n").isNull(), F.array(F.lit("missing"))).when(F.col("records").isNull(), F.array(F.lit("unexpected"))).when(F.col("_n") > 1, F.array(F.lit("doubled")))
    codes = F.coalesce(codes, F.array_compact(F.array(F.when(unlike("records"), "records"), F.when(unlike("sha256"), "sha256"))))
    return met.select("view", F.explode(codes).alias("code"))
