"""Checks across the artifacts of a run: contract, job rows, traces, private reports and run evidence.

No side is dropped by a join: what is missing, extra or doubled becomes a row with its code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHA256 = "^[0-9a-f]{64}$"


@dataclass(frozen=True)
class Contract:
    """What a run may ask of the model: its name and other names of its responses, sampling, tokens of a call and of a job."""

    model: str
    aliases: tuple[str, ...]
    temperature: float
    max_tokens: int
    max_job_tokens: int


def _blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit(""))) == ""


def _no_count(c: str) -> Column:
    return F.coalesce(F.col(c) < 0, F.lit(True))


def call_budgets(calls: DataFrame, responses: DataFrame, contract: Contract) -> DataFrame:
    """Each observed call beside the model response of its place in the trace, with the tokens that its job had left.

    calls: job_id, position (distinct in a job) and the call's fields; responses: job_id, sequence (distinct in a job),
    trace_model and its usage (trace_input, trace_output, trace_total). ``spent`` is what earlier responses
    used, ``allowed`` the max_tokens that the call should have asked for. Both sides are stacked and dealt once by job; a
    job's rows stream through ordered windows, in which a call stands before the response of its place, so its size
    costs no memory. Null job ids match nothing.
    """
    said = [c for c in responses.columns if c not in ("job_id", "sequence")]
    both = calls.withColumn("_asked", F.lit(True)).unionByName(responses.withColumn("_said", F.lit(True)), allowMissingColumns=True).repartition("job_id")
    both = both.withColumn("_n", F.row_number().over(Window.partitionBy("job_id", "_said").orderBy("position", "sequence")))
    job = Window.partitionBy("job_id").orderBy("_n", F.col("_said").asc_nulls_first())
    met = both.withColumns(
        {
            "_next": F.lead(F.struct("_n", "_said", "sequence", *said)).over(job),
            "_paired": F.lag(F.when(F.col("_asked"), F.col("_n"))).over(job) == F.col("_n"),
            "spent": F.coalesce(F.sum("trace_total").over(job.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    known = F.col("job_id").isNotNull()
    met = met.where(F.col("_asked") | ~known | ~F.coalesce("_paired", F.lit(False)))
    answer = F.col("_asked") & known & (F.col("_next._n") == F.col("_n")) & F.col("_next._said")
    met = met.withColumns({c: F.when(F.col("_asked"), F.when(answer, F.col(f"_next.{c}"))).otherwise(F.col(c)) for c in ("_said", "sequence", *said)}).drop("_next", "_paired")
    left = F.lit(contract.max_job_tokens) - F.col("spent") - F.col("prompt_token_upper_bound")
    return met.withColumns({"place": F.col("_n") - 1, "left": left}).withColumn("allowed", F.least(F.lit(contract.max_tokens).cast("long"), "left"))


def call_violations(calls: DataFrame, responses: DataFrame, contract: Contract) -> DataFrame:
    """job_id, place and code of every mismatch between observed calls and the trace, not only of a job's first.

    Cases: a call or a response without the other gets one code and no further ones; null fields count as wrong; a
    job with neither has no rows; after a call that overspends, later ones are measured by what was spent.
    """

    def bad(c: Column) -> Column:
        return F.coalesce(c, F.lit(True))

    alone = {  # what a call tells by itself is found before the rows are dealt
        "status": bad(F.col("status") != "completed"),
        "request_model": bad(F.col("model") != contract.model),
        "response_model": bad(~F.col("response_model").isin(contract.model, *contract.aliases)),
        "response_id": _blank("response_id"),
        "response_object": bad(F.col("response_object") != "chat.completion"),
        "identity_model": ~F.col("identity_model").eqNullSafe(F.col("response_model")),
        "prompt_hash": bad(~F.col("prompt_hash").rlike(SHA256)),
        "started_at": _blank("started_at"),
        "message_count": _no_count("message_count"),
        "tool_count": _no_count("tool_count"),
        "temperature": bad(F.col("temperature") != contract.temperature),
        "prompt_token_upper_bound": bad(F.col("prompt_token_upper_bound") <= 0),
        "retry_count": _no_count("retry_count"),
        "latency_ms": bad(F.isnan("latency_ms") | (F.col("latency_ms") < 0) | (F.col("latency_ms") == float("inf"))),
    }
    flags = sum((F.when(c, 2**k).otherwise(0) for k, c in enumerate(alone.values())), F.lit(0))
    needed = ("job_id", "position", "call_index", "response_id", "response_model", "input_tokens", "output_tokens", "total_tokens", "prompt_token_upper_bound", "max_tokens")
    b = call_budgets(calls.select(*needed, flags.cast("int").alias("_flags")), responses.select("job_id", "sequence", "trace_model", "trace_input", "trace_output", "trace_total"), contract)
    again = F.row_number().over(Window.partitionBy("job_id", "response_id").orderBy("_n"))
    b = b.withColumn("_again", F.when(F.col("response_id").isNotNull(), again))
    usage = ~(F.col("input_tokens").eqNullSafe(F.col("trace_input")) & F.col("output_tokens").eqNullSafe(F.col("trace_output")) & F.col("total_tokens").eqNullSafe(F.col("trace_total")))
    checks = {
        **{name: F.col("_flags").bitwiseAND(F.lit(2**k)) != 0 for k, name in enumerate(alone)},
        "call_index": bad(F.col("call_index") != F.col("place")),
        "trace_model": ~F.col("response_model").eqNullSafe(F.col("trace_model")),
        "repeated_response_id": F.coalesce(F.col("_again") > 1, F.lit(False)),
        "usage": usage,
        "call_beyond_budget": F.coalesce(F.col("left") <= 0, F.lit(False)),
        "max_tokens": F.coalesce(F.col("left") > 0, F.lit(False)) & bad(F.col("max_tokens") != F.col("allowed")),
        "input_beyond_bound": F.coalesce(F.col("trace_input") > F.col("prompt_token_upper_bound"), F.lit(False)),
        "output_beyond_max_tokens": F.coalesce((F.col("left") > 0) & (F.col("trace_output") > F.col("allowed")), F.lit(False)),
        "job_beyond_budget": F.coalesce(F.col("spent") + F.col("trace_total") > contract.max_job_tokens, F.lit(False)),
    }
    both = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))
    codes = F.when(F.col("_said").isNull(), F.array(F.lit("call_without_response"))).when(F.col("_asked").isNull(), F.array(F.lit("response_without_call"))).otherwise(both)
    return b.select("job_id", F.col("place").cast("long").alias("place"), F.explode(codes).alias("code"))


SIDES = ("assignment", "row", "trace", "report", "evidence")


def artifact_sets(assignments: DataFrame, rows: DataFrame, traces: DataFrame, reports: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row per job that any side knows: how often each has it, its status, the trace ids, ``codes`` and ``complete``.

    assignments: job_id; rows: job_id, status, trace_id; traces, reports: job_id, trace_id; evidence: job_id. The five
    sides are stacked and meet in one aggregation by job. Cases: a null or blank job_id is a row of its own with the
    code of its side; a job outside the contract, doubled, unfinished or without a side has a code each.
    """
    sides = dict(zip(SIDES, (assignments, rows, traces, reports, evidence), strict=True))
    stacked = None
    for name, df in sides.items():
        one = df.select(F.trim(F.coalesce(F.col("job_id").cast("string"), F.lit(""))).alias("job_id"), F.lit(name).alias("side"), (F.col("trace_id") if "trace_id" in df.columns else F.lit(None)).cast("string").alias("trace_id"), (F.col("status") if "status" in df.columns else F.lit(None)).cast("string").alias("status"))
        stacked = one if stacked is None else stacked.unionByName(one)

    def of(name: str, c: str) -> Column:
        return F.min(F.when(F.col("side") == name, F.col(c)))

    counts = [F.count(F.when(F.col("side") == s, 1)).alias(f"n_{s}") for s in SIDES]
    by = stacked.groupBy("job_id").agg(*counts, of("row", "status").alias("status"), *[of(s, "trace_id").alias(f"{s}_trace_id") for s in ("row", "trace", "report")])
    known, wanted = F.col("n_assignment") > 0, (F.col("n_row") > 0) & (F.col("status") == "completed")
    codes = F.array(
        *[F.when((F.col("job_id") == "") & (F.col(f"n_{s}") > 0), f"blank_{s}") for s in SIDES],
        *[F.when((F.col("job_id") != "") & (F.col(f"n_{s}") > 1), f"double_{s}") for s in SIDES],
        *[F.when((F.col("job_id") != "") & ~known & (F.col(f"n_{s}") > 0), f"{s}_outside_contract") for s in SIDES[1:]],
        F.when(known & (F.col("job_id") != "") & (F.col("n_row") == 0), "missing_row"),
        F.when(known & (F.col("n_row") > 0) & F.coalesce(F.col("status") != "completed", F.lit(True)), "not_completed"),
        *[F.when(known & wanted & (F.col(f"n_{s}") == 0), f"missing_{s}") for s in SIDES[2:]],
        *[F.when(known & ~F.coalesce(wanted, F.lit(False)) & (F.col(f"n_{s}") > 0), f"{s}_without_completed_row") for s in SIDES[2:]],
        F.when((F.col("n_row") > 0) & (F.col("n_trace") > 0) & ~F.col("row_trace_id").eqNullSafe(F.col("trace_trace_id")), "trace_id_of_row"),
        F.when((F.col("n_report") > 0) & (F.col("n_trace") > 0) & ~F.col("report_trace_id").eqNullSafe(F.col("trace_trace_id")), "trace_id_of_report"),
    )
    return by.withColumn("codes", F.array_compact(codes)).withColumn("complete", known & (F.size("codes") == 0))


def artifact_issues(sets: DataFrame) -> DataFrame:
    """job_id and code, a row each."""
    return sets.select("job_id", F.explode("codes").alias("code"))


def shared_response_ids(calls: DataFrame) -> DataFrame:
    """response_id, n and jobs of ids that more than one call has, in one job or in several; blank ids do not count."""
    return calls.where(~_blank("response_id")).groupBy("response_id").agg(F.count("*").alias("n"), F.count_distinct("job_id").alias("jobs")).where("n > 1")
