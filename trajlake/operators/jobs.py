"""Job tables: status, reports per scenario, scale decisions, shards, budgets and state transitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TERMINAL = ("completed", "failed", "infrastructure_failed")
WAITING = ("pending", "running")


def scenario_key(column: str = "scenario_id", default: str = "default") -> Column:
    """A blank or missing key counts as the default one."""
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))


def ratio(part: Column, whole: Column) -> Column:
    """Share rounded to six digits; 0 of nothing."""
    return F.round(F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)), 6)


def metric(name: str) -> Column:
    """Mean of a metric over all rows; a row without it counts as 0."""
    return F.round(F.avg(F.coalesce(F.element_at(F.col("metrics"), name), F.lit(0.0))), 6)


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count("*").alias("jobs"))


def reportable(jobs: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """Rows that are neither pending nor running, of the selected jobs if any are named."""
    out = jobs.where(~F.col("status").isin(*WAITING))
    return out if selected is None else out.join(selected.select("job_id").distinct(), "job_id", "left_semi")


def reward() -> Column:
    return F.col("success").cast("double")


def quality_report(jobs: DataFrame) -> DataFrame:
    """One row: counts, rates, pass@k as observed, reward moments, trace and infrastructure figures."""
    groups = jobs.groupBy(scenario_key().alias("g")).agg(F.count("*").alias("n"), F.max("success").alias("any"), F.stddev_pop(reward()).alias("std"))
    over = groups.agg(
        F.round(F.coalesce(F.avg(F.col("any").cast("double")), F.lit(0.0)), 6).alias("pass_at_observed_k"),
        F.round(F.coalesce(F.avg(F.when(F.col("n") > 1, F.col("std"))), F.lit(0.0)), 6).alias("in_group_reward_std_mean"),
        F.count(F.when((F.col("n") > 1) & (F.col("std") == 0), 1)).alias("low_information_groups"),
    )
    named = F.nullif(F.col("trace_id"), F.lit(""))
    total = jobs.agg(
        F.count("*").alias("rollouts"),
        F.countDistinct(F.nullif(F.col("scenario_id"), F.lit(""))).alias("scenario_count"),
        F.coalesce(F.sum("success"), F.lit(0)).cast("long").alias("successes"),
        ratio(F.sum("success"), F.count("*")).alias("success_rate"),
        F.round(F.coalesce(F.stddev_pop(reward()), F.lit(0.0)), 6).alias("episode_reward_std"),
        F.countDistinct(named).alias("unique_traces"),
        (F.count(named) - F.countDistinct(named)).alias("duplicate_traces"),
        F.count(F.when(F.col("status") == "infrastructure_failed", 1)).alias("infrastructure_failures"),
    )
    return total.crossJoin(over)  # one row by one row


def metric_averages(jobs: DataFrame) -> DataFrame:
    """Mean of each metric over all rows, also those that lack it."""
    total = jobs.agg(F.count("*").alias("rows"))
    sums = jobs.select(F.explode("metrics").alias("metric", "value")).groupBy("metric").agg(F.sum("value").alias("total"))
    return sums.join(F.broadcast(total)).select("metric", F.round(F.col("total") / F.col("rows"), 6).alias("average"))


def success_by(jobs: DataFrame, key: str) -> DataFrame:
    return jobs.where(F.col(key) != "").groupBy(F.col(key).alias("goal_type")).agg(F.count("*").alias("rollouts"), ratio(F.sum("success"), F.count("*")).alias("success_rate"))


def reward_groups(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(scenario_key().alias("scenario_id")).agg(F.count("*").alias("rollouts"), F.round(F.avg(reward()), 6).alias("reward_mean"), F.round(F.stddev_pop(reward()), 6).alias("reward_std"))


def pass_at_k(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(scenario_key().alias("scenario_id")).agg(
        F.count("*").alias("rollouts"), F.sum("success").cast("long").alias("successes"), F.max(F.col("success").cast("double")).alias("pass_at_k"), ratio(F.sum("success"), F.count("*")).alias("success_rate")
    )


def scenario_quality(jobs: DataFrame) -> DataFrame:
    failed = F.count(F.when(F.col("status") == "infrastructure_failed", 1))
    return jobs.groupBy(scenario_key().alias("scenario_id")).agg(
        F.count("*").alias("rollouts"),
        F.sum("success").cast("long").alias("successes"),
        ratio(F.sum("success"), F.count("*")).alias("success_rate"),
        metric("verifier_hidden_command_passed").alias("hidden_command_pass_rate"),
        metric("verifier_all_non_agent_passed").alias("all_non_agent_pass_rate"),
        metric("verifier_agent_termination_passed").alias("agent_stop_rate"),
        failed.alias("infrastructure_failures"),
        ratio(failed, F.count("*")).alias("infrastructure_failure_rate"),
        metric("tool_calls").alias("average_tool_calls"),
        F.round(F.avg(F.coalesce("tokens", F.lit(0))), 6).alias("average_tokens"),
    )


def scale_candidates(report: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """scenario_id, scale_candidate and the thresholds it misses, in order."""
    checks = [
        ("rollouts", F.col("rollouts") < thresholds["rollouts"]),
        ("success_rate", F.col("success_rate") < thresholds["success_rate"]),
        ("hidden_command_pass_rate", F.col("hidden_command_pass_rate") < thresholds["hidden_command_pass_rate"]),
        ("all_non_agent_pass_rate", F.col("all_non_agent_pass_rate") < thresholds["all_non_agent_pass_rate"]),
        ("infrastructure_failure_rate", F.col("infrastructure_failure_rate") > thresholds["infrastructure_failure_rate"]),
        ("average_tool_calls", F.col("average_tool_calls") < thresholds["average_tool_calls"]),
    ]
    failures = F.array_join(F.array_compact(F.array(*[F.when(c, n) for n, c in checks])), ",")
    return report.select("scenario_id", failures.alias("candidate_failures")).withColumn("scale_candidate", F.col("candidate_failures") == "")


def continuation(report: DataFrame, min_success_rate: float, min_unique_traces: int, max_failures: int) -> DataFrame:
    """Decision on a one-row report: what fails, whether to go on, and the next action."""
    failures = F.array_join(
        F.array_compact(
            F.array(
                F.when(F.col("success_rate") < min_success_rate, "success_rate"),
                F.when(F.col("unique_traces") < min_unique_traces, "unique_traces"),
                F.when(F.col("infrastructure_failures") > max_failures, "infrastructure_failures"),
            )
        ),
        ",",
    )
    return report.select("rollouts", failures.alias("failures")).select("rollouts", "failures", F.when(F.col("failures") == "", "continue").otherwise("hold").alias("decision"), F.when(F.col("failures").contains("infrastructure"), "fix_infrastructure").when(F.col("failures") == "", "run_next_shard").otherwise("review_failures").alias("next_action"))


def token_estimates(jobs: DataFrame) -> DataFrame:
    """Pending rows with their scenario's mean observed tokens, or the mean of all."""
    seen = jobs.where(~F.col("status").isin(*WAITING) & (F.col("tokens") > 0))
    means = seen.groupBy(scenario_key().alias("scenario_id")).agg(F.avg("tokens").alias("mean"))
    overall = seen.agg(F.coalesce(F.avg("tokens"), F.lit(0.0)).alias("fallback"))
    waiting = jobs.where(F.col("status").isin(*WAITING)).select("job_id", scenario_key().alias("scenario_id"))
    return waiting.join(means, "scenario_id", "left").join(F.broadcast(overall)).select("job_id", "scenario_id", F.coalesce("mean", "fallback").alias("estimate"))


def scale_estimate(jobs: DataFrame) -> DataFrame:
    return token_estimates(jobs).groupBy("scenario_id").agg(F.count("*").alias("pending_jobs"), F.round(F.max("estimate"), 4).alias("observed_average_tokens"), F.round(F.sum("estimate"), 2).alias("estimated_tokens"))


#: Ranges that an order is cut to, and values of it that are drawn to place the cuts.
RANGES, DRAWN = 1024, 16_384


def range_of(df: DataFrame, order: str) -> Column:
    """Number of the range, from 0, that a row's value of a column lies in; null is in the first.

    The cuts are quantiles of the values with the smallest hashes, drawn once and at most DRAWN of them.
    The number is an expression of the value alone: it is the same wherever and how often the row is read.
    """
    drawn = sorted(r[0] for r in df.select(order).where(F.col(order).isNotNull()).orderBy(F.xxhash64(order), order).limit(DRAWN).collect())
    cuts = sorted({drawn[k * len(drawn) // RANGES] for k in range(1, RANGES)}) if drawn else []
    if not cuts:
        return F.lit(0)
    wide = math.isqrt(len(cuts)) + 1
    rows = [cuts[k : k + wide] for k in range(0, len(cuts), wide)]

    def upto(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= F.col(order)))

    row = upto(F.array(*[F.lit(r[0]) for r in rows]))
    inside = F.element_at(F.array(*[F.array(*[F.lit(c) for c in r]) for r in rows]), F.greatest(row, F.lit(1)))
    return F.when(F.col(order).isNull() | (row == 0), 0).otherwise((row - 1) * wide + upto(inside))


def running(df: DataFrame, order: str, sums: dict[str, Column]) -> DataFrame:
    """Rows with sums up to and with each of them, in order of a column of distinct values, without one global sort task.

    Ranges of the order are summed apart; the prefix sums of their totals, one row a range, are added.
    """
    named = {f"_s{k}": c for k, c in enumerate(sums.values())}
    cut = df.withColumns({"_range": range_of(df, order), **named})
    totals = {r["_range"]: r for r in cut.groupBy("_range").agg(*[F.sum(c).alias(c) for c in named]).collect()}  # at most RANGES rows
    if not totals:
        return cut.select(*df.columns, *[F.col(c).alias(name) for name, c in zip(sums, named, strict=True)])
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut
    for name, c in zip(sums, named, strict=True):
        before = [0]
        for k in range(max(totals)):
            before.append(before[-1] + (totals[k][c] or 0 if k in totals else 0))
        out = out.withColumn(name, F.coalesce(F.sum(c).over(within), F.lit(0)) + F.get(F.array(*[F.lit(x) for x in before]), "_range"))
    return out.select(*df.columns, *sums)


def numbered(df: DataFrame, order: str, name: str = "rn") -> DataFrame:
    """Rows with their number, from 1, in order of a column of distinct values."""
    return running(df, order, {name: F.lit(1).cast("long")})


def scale_shards(jobs: DataFrame, size: int, cost_per_million: float) -> DataFrame:
    """Chunks of pending jobs by job_id (as text), with their estimated tokens and cost."""
    shard = F.floor((F.col("rn") - 1) / max(1, size)).cast("long")
    return numbered(token_estimates(jobs), "job_id").groupBy(shard.alias("shard_index")).agg(
        F.count("*").alias("max_jobs"), F.min("job_id").alias("first_job_id"), F.max("job_id").alias("last_job_id"), F.round(F.sum("estimate"), 2).alias("estimated_tokens"), F.round(F.sum("estimate") / 1e6 * cost_per_million, 4).alias("estimated_cost")
    )


def selected_status(jobs: DataFrame, selected: DataFrame) -> DataFrame:
    """One row on an explicit set of jobs: found, missing, completed, successes, all terminal."""
    asked = selected.select("job_id").distinct()
    met = asked.join(jobs.select("job_id", "status", "success", "tokens"), "job_id", "left")
    found = F.count("status")
    return met.agg(
        F.count("*").alias("selected_jobs"),
        found.alias("found_jobs"),
        (F.count("*") - found).alias("missing_jobs"),
        F.count(F.when(F.col("status") == "completed", 1)).alias("completed_jobs"),
        F.coalesce(F.sum("success"), F.lit(0)).cast("long").alias("successes"),
        ratio(F.sum("success"), found).alias("success_rate"),
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens"),
        ((found > 0) & (F.count("*") == found) & (F.count(F.when(F.col("status").isin(*TERMINAL), 1)) == found)).alias("all_selected_terminal"),
    )


def budget_prefix(jobs: DataFrame, budget: int, order: str = "job_id") -> DataFrame:
    """Jobs admitted in order while their summed tokens fit; the first that does not fit ends admission."""
    placed = running(jobs.select("job_id", "tokens", *({order} - {"job_id", "tokens"})), order, {"position": F.lit(1).cast("long"), "used": F.col("tokens").cast("long")})
    stop = placed.where(F.col("used") > budget).agg(F.min("position").alias("stop"))  # one row
    return placed.join(F.broadcast(stop)).where(F.col("stop").isNull() | (F.col("position") < F.col("stop"))).select("job_id", "position", "used")


def reserved_prefix(jobs: DataFrame, budgets: dict[str, tuple[int, int]], order: str = "job_id", settle: int = 1) -> DataFrame:
    """Admission in order under several budgets: job_id, position, admitted and reasons (of the first refused job, else empty).

    ``budgets`` names a column of whole numbers with what each job really used, the limit, and what a job may use at
    worst (0: nothing is reserved). When a job is asked for, those ``settle`` or more places before it count with what
    they used, the ones between with their worst case. It is refused if that alone reaches a limit, or would pass it together
    with its own worst case; the first refusal ends admission. Sums run over ranges of the order, not in one task. Cases: a null use
    counts 0; ``order`` holds distinct values.
    """
    sums = {"position": F.lit(1).cast("long"), **{f"_u_{c}": F.coalesce(F.col(c), F.lit(0)).cast("long") for c in budgets}}
    placed = running(jobs.select("job_id", *dict.fromkeys([order, *budgets])) if order != "job_id" else jobs.select("job_id", *budgets), order, sums)
    known = placed.select((F.col("position") + settle).alias("position"), *[F.col(f"_u_{c}").alias(f"_d_{c}") for c in budgets])
    met = placed.select("job_id", "position").join(known, "position", "left")
    open_ = F.least(F.lit(settle - 1), F.col("position") - 1)
    reasons = []
    for c, (limit, worst) in budgets.items():
        done = F.coalesce(F.col(f"_d_{c}"), F.lit(0))
        reasons.append(F.when(done >= limit, f"{c}_spent"))
        if worst:
            reasons.append(F.when(done + (open_ + 1) * worst > limit, f"{c}_reserved"))
    met = met.withColumn("reasons", F.array_compact(F.array(*reasons)))
    stop = met.where(F.size("reasons") > 0).agg(F.min("position").alias("stop"))  # one row
    met = met.join(F.broadcast(stop))
    admitted = F.col("stop").isNull() | (F.col("position") < F.col("stop"))
    return met.select("job_id", "position", admitted.alias("admitted"), F.when(F.col("position") == F.col("stop"), F.col("reasons")).otherwise(F.array().cast("array<string>")).alias("reasons"))


def transitions(jobs: DataFrame, max_retries: int) -> DataFrame:
    """Next state of each job after its outcome: retry, give up, complete (it has a trace) or fail."""
    infra = F.col("status") == "infrastructure_failed"
    state = (
        F.when(F.col("status").isin(*WAITING), "pending")
        .when(infra & (F.col("attempts") <= max_retries), "pending")
        .when(infra, "infrastructure_failed")
        .when(F.coalesce(F.col("trace_id"), F.lit("")) != "", "completed")
        .otherwise("failed")
    )
    return jobs.select("job_id", F.col("status").alias("outcome"), "attempts", state.alias("next_status"))


def usage_decreases(totals: DataFrame) -> DataFrame:
    """Rows whose total is negative or below an earlier one of the same job; totals: job_id, position, total."""
    earlier = F.max("total").over(Window.partitionBy("job_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1))
    return totals.withColumn("earlier", earlier).where((F.col("total") < 0) | (F.col("total") < F.col("earlier"))).select("job_id", "position", "total", "earlier")


def scheduler_totals(jobs: DataFrame) -> DataFrame:
    """Totals of tokens and cost; what was consumed, else what the row says."""
    return jobs.agg(F.count("*").alias("jobs"), F.sum(F.coalesce("consumed_tokens", "tokens")).cast("long").alias("tokens"), F.sum(F.coalesce("consumed_cost", "cost").cast("decimal(18,6)")).cast("decimal(28,6)").cast("double").alias("cost"))


def ranked_reports(reports: DataFrame, best: list[str], least: list[str], tie: str, k: int) -> DataFrame:
    """First k reports: largest of the first columns, smallest of the others; missing counts as 0."""
    order = [F.coalesce(F.col(c), F.lit(0)).desc() for c in best] + [F.coalesce(F.col(c), F.lit(0)).asc() for c in least]
    return reports.orderBy(*order, F.col(tie).asc()).limit(k)


def review_sample(jobs: DataFrame, k: int) -> DataFrame:
    """Jobs that did not complete first, then by status and id."""
    return jobs.orderBy((F.col("status") == "completed").asc(), "status", "job_id").limit(k).select("job_id", "status")


def page(df: DataFrame, order: str, offset: int, limit: int) -> DataFrame:
    return df.orderBy(order).offset(offset).limit(limit)


def new_jobs(existing: DataFrame, submitted: DataFrame) -> DataFrame:
    """Existing rows and those submitted whose id is new (the first of each)."""
    first = submitted.withColumn("_n", F.row_number().over(Window.partitionBy("job_id").orderBy("position"))).where("_n = 1").drop("_n")
    return existing.unionByName(first.join(existing.select("job_id"), "job_id", "left_anti"), allowMissingColumns=True)
