"""Recovery of running jobs after a crash, from the append-only ledger of their attempts.

Only what is certain is charged: an attempt is closed only if it is the latest, all others ended, and every call that it began has its receipt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def attempts(ledger: DataFrame) -> DataFrame:
    """One row per attempt of a job: its admission, receipts and end.

    ledger: job_id, attempt, kind (admitted, call_started, call_completed, terminal), call_id, happened_at, latency_ms, tokens,
    cost and floor_ms. Rows are first brought together by call, so that a job with very many calls is spread; a receipt
    written twice counts once.
    """
    by_call = ledger.groupBy("job_id", "attempt", "call_id").agg(
        F.count(F.when(_is("call_started"), 1)).alias("started"),
        F.count(F.when(_is("call_completed"), 1)).alias("completed"),
        F.max(F.when(_is("call_completed"), F.col("latency_ms").cast("decimal(28,6)"))).alias("latency"),
        F.max(F.when(_is("call_completed"), F.col("tokens"))).alias("tokens"),
        F.max(F.when(_is("call_completed"), F.col("cost").cast("decimal(28,10)"))).alias("cost"),
        F.max(F.when(_is("call_completed"), F.col("happened_at").cast("timestamp"))).alias("received"),
        F.min(F.when(_is("admitted"), F.col("happened_at").cast("timestamp"))).alias("admitted"),
        F.max(F.when(_is("admitted"), F.col("floor_ms").cast("decimal(28,6)"))).alias("floor"),
        F.count(F.when(_is("terminal"), 1)).alias("ended"),
    )
    return by_call.groupBy("job_id", "attempt").agg(
        F.min("admitted").alias("admitted_at"),
        F.max("floor").alias("floor_ms"),
        F.count(F.when((F.col("started") > 0) & (F.col("completed") == 0), 1)).alias("open_calls"),
        F.count(F.when((F.col("started") == 0) & (F.col("completed") > 0), 1)).alias("unasked_calls"),
        F.coalesce(F.sum("latency"), F.lit(0)).cast("decimal(28,6)").alias("latency_ms"),
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.sum("cost"), F.lit(0)).cast("decimal(28,10)").alias("cost"),
        F.max("received").alias("received_at"),
        (F.sum("ended") > 0).alias("ended"),
    )


def recoveries(jobs: DataFrame, ledger: DataFrame, published: DataFrame, now: Column, job_seconds: float) -> DataFrame:
    """What becomes of each running job: job_id, action (recovered, left, refused), reason, and what a recovery charges.

    jobs: job_id, status, attempts (as the scheduler counts them), contracted; published: job_id and artifact (trace, or another). An
    attempt's time is the greatest of the wall time since its admission, the sum of its calls' latencies and its
    floor; an admission that left no attempt is charged the whole time of a job. Cases: a null count of attempts is 0;
    a clock before an admission or a receipt refuses; a job without ledger rows has no attempts.
    """
    latest = F.struct("attempt", "ended", "admitted_at", "floor_ms", "open_calls", "unasked_calls", "latency_ms", "tokens", "cost", "received_at")
    known = attempts(ledger).groupBy("job_id").agg(F.count("*").alias("known"), F.count(F.when(~F.col("ended"), 1)).alias("open"), F.max_by(latest, "attempt").alias("last"))
    shown = published.groupBy("job_id").agg(F.coalesce(F.max(F.col("artifact") == "trace"), F.lit(False)).alias("trace"), F.lit(True).alias("residue"))
    j = jobs.where(F.col("status") == "running").select("job_id", F.coalesce("attempts", F.lit(0)).cast("long").alias("attempts"), F.coalesce("contracted", F.lit(False)).alias("contracted"))
    j = j.join(known, "job_id", "left").join(shown, "job_id", "left").withColumns({"known": F.coalesce("known", F.lit(0)), "open": F.coalesce("open", F.lit(0)), "trace": F.coalesce("trace", F.lit(False)), "residue": F.coalesce("residue", F.lit(False))})
    gap = F.col("attempts") == F.col("known") + 1
    last = F.col("last")
    wall = (F.unix_micros(now) - F.unix_micros(last["admitted_at"])).cast("decimal(28,6)") / F.lit(1000).cast("decimal(10,0)")
    reason = (
        F.when(~F.col("contracted"), "refused:outside_contract")
        .when(F.col("attempts") == 0, "refused:no_admission")
        .when(F.col("trace"), "left:trace_published")
        .when(~gap & (F.col("attempts") != F.col("known")), "refused:attempt_count")
        .when(gap & (F.col("open") > 0), "refused:open_attempt_before_gap")
        .when(gap & F.col("residue"), "refused:artifact_residue")
        .when(gap, "recovered:admission_gap")
        .when(F.col("open") == 0, "left:all_ended")
        .when((F.col("open") > 1) | last["ended"], "refused:not_the_latest")
        .when(F.col("residue"), "refused:artifact_residue")
        .when((last["open_calls"] > 0) | (last["unasked_calls"] > 0), "refused:unknown_usage")
        .when(last["admitted_at"].isNull(), "refused:no_marker")
        .when((now < last["admitted_at"]) | F.coalesce(now < last["received_at"], F.lit(False)), "refused:clock")
        .otherwise("recovered:interrupted")
    )
    j = j.withColumn("reason", reason)
    closed, whole = F.col("reason") == "recovered:interrupted", F.col("reason") == "recovered:admission_gap"
    elapsed = F.greatest(wall.cast("decimal(28,6)"), last["latency_ms"], F.coalesce(last["floor_ms"], F.lit(0).cast("decimal(28,6)")))
    return j.select(
        "job_id",
        F.substring_index("reason", ":", 1).alias("action"),
        F.substring_index("reason", ":", -1).alias("reason"),
        F.when(closed, last["attempt"].cast("long")).when(whole, F.col("attempts")).alias("attempt"),
        F.when(closed, last["tokens"]).when(whole, F.lit(0)).cast("long").alias("tokens"),
        F.when(closed, last["cost"]).when(whole, F.lit(0)).cast("decimal(28,10)").alias("cost"),
        F.when(closed, elapsed).when(whole, F.lit(job_seconds * 1000)).cast("double").alias("elapsed_ms"),
    )
