"""Review queues and gates: risk scores, coverage, decisions and release conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.operators.digests import ordered_digests

# Weights of risk reasons; any other reason weighs 10.
RISK_WEIGHTS = {
    "hidden_content_leak": 1_000,
    "hard_verifier_bypass": 1_000,
    "schema_invalid": 500,
    "replay_invalid": 500,
    "success_not_reproduced": 500,
    "infrastructure_failure": 300,
    "duplicate_trace": 100,
    "unsuccessful": 75,
    "risky_termination": 40,
}
CALM = ("completed", "final_answer", "success")


def risk(summaries: DataFrame) -> DataFrame:
    """trace_id, sorted distinct reasons and score; summaries: trace_id, flags, success, termination, declared."""
    reasons = F.array_sort(F.array_distinct(F.concat("flags", F.array_compact(F.array(F.when(~F.col("success"), "unsuccessful"), F.when(~F.col("termination").isin(*CALM), "risky_termination"))))))
    weights = F.create_map(*[F.lit(x) for pair in RISK_WEIGHTS.items() for x in pair])
    score = F.aggregate("reasons", F.lit(0), lambda acc, r: acc + F.coalesce(F.element_at(weights, r), F.lit(10)))
    return summaries.withColumn("reasons", reasons).withColumn("risk_score", (F.col("declared") + score).cast("long"))


def queue(scored: DataFrame, k: int) -> DataFrame:
    """First k by falling risk, scenario and trace, numbered from 0."""
    head = scored.orderBy(F.desc("risk_score"), "scenario_id", "trace_id").limit(k)
    return head.withColumn("position", (F.row_number().over(Window.orderBy(F.desc("risk_score"), "scenario_id", "trace_id")) - 1).cast("int"))


def _item() -> Column:
    """SHA-256 of an item's JSON, keys in order, without blanks."""
    return F.sha2(F.to_json(F.struct("position", "reasons", "risk_score", "scenario_id", "trace_id")), 256)


def sealed(items: DataFrame) -> DataFrame:
    """The items of a queue (trace_id, scenario_id, reasons, risk_score, position) with the hash of each."""
    return items.withColumn("item_sha256", _item())


def seal(items: DataFrame) -> DataFrame:
    """One row: items and the hash over their hashes in order of position; none for an empty queue."""
    made = ordered_digests(items, F.lit("queue"), F.col("position"), F.col("item_sha256"), ",")
    return made.select(F.col("n").alias("items"), F.col("sha256").alias("queue_sha256"))


def seal_violations(recorded: DataFrame, declared: DataFrame, scored: DataFrame, k: int) -> DataFrame:
    """trace_id and code of all that a recorded queue has otherwise than it computes to; the whole queue's codes have no trace.

    recorded: sealed items; declared: the recorded seal, one row or none; scored: what ``risk`` gives now. Codes of an item: unexpected, missing, doubled, item_sha256
    (its hash is not that of its own fields), and scenario_id, reasons, risk_score or position where they differ. Codes of the queue: items, queue_sha256.
    """
    fields = ("scenario_id", "reasons", "risk_score", "position")
    own = recorded.groupBy("trace_id").agg(F.count("*").alias("_n"), F.first(F.struct(*fields)).alias("_r"), F.bool_and(F.col("item_sha256").eqNullSafe(_item())).alias("_sound"))
    now = queue(scored, k).select("trace_id", F.struct(*[F.col(c).cast(t).alias(c) for c, t in zip(fields, ("string", "array<string>", "long", "int"), strict=True)]).alias("_q"))
    met = own.join(now, "trace_id", "full")
    unlike = [F.when(~F.col(f"_r.{c}").cast(t).eqNullSafe(F.col(f"_q.{c}")), F.lit(c)) for c, t in zip(fields, ("string", "array<string>", "long", "int"), strict=True)]
    both = F.array_compact(F.array(F.when(F.col("_n") > 1, "doubled"), F.when(~F.col("_sound"), "item_sha256"), *unlike))
    codes = F.when(F.col("_n").isNull(), F.array(F.lit("missing"))).when(F.col("_q").isNull(), F.array(F.lit("unexpected"))).otherwise(both)
    said = declared.agg(F.max("items").alias("i"), F.max("queue_sha256").alias("h"))
    true = seal(sealed(recorded.drop("item_sha256"))).agg(F.max("items").alias("i2"), F.max("queue_sha256").alias("h2"))
    whole = said.join(F.broadcast(true)).select(F.lit(None).cast("string").alias("trace_id"), F.explode(F.array_compact(F.array(F.when(~F.col("i").eqNullSafe(F.col("i2")), "items"), F.when(~F.col("h").eqNullSafe(F.col("h2")), "queue_sha256")))).alias("code"))
    return met.select("trace_id", F.explode(codes).alias("code")).unionByName(whole)


def coverage(source: DataFrame, selected: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: distinct values there are, those that the selection has, and whether that is all."""

    def values(df: DataFrame, name: str) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
        return df.select(F.explode(entries).alias("e")).select("e.field", "e.value").distinct().withColumn(name, F.lit(1))

    met = values(source, "a").join(values(selected, "b"), ["field", "value"], "left")
    return met.groupBy("field").agg(F.count("*").alias("available"), F.count("b").alias("covered"), (F.count("*") == F.count("b")).alias("complete"))


def gate(expected: DataFrame, decisions: DataFrame, least_rate: float) -> DataFrame:
    """One row: missing, unexpected, duplicate and unresolved decisions, the acceptable rate and the verdict.

    decisions: trace_id, verdict, quarantine; of several for a trace the smallest counts.
    """
    ids = expected.select("trace_id").distinct().withColumn("wanted", F.lit(1))
    per_trace = decisions.groupBy("trace_id").agg(F.count("*").alias("n"), F.min(F.struct("verdict", "quarantine")).alias("d"))
    met = ids.join(per_trace, "trace_id", "full_outer")
    known = F.col("wanted").isNotNull() & F.col("n").isNotNull()
    out = met.agg(
        F.count("wanted").alias("required"),
        F.count(F.when(F.col("n").isNull(), 1)).alias("missing"),
        F.count(F.when(F.col("wanted").isNull(), 1)).alias("unexpected"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicates"),
        F.count(F.when(known & (F.col("d.verdict") == "critical") & ~F.col("d.quarantine"), 1)).alias("critical_open"),
        F.count(F.when(known & (F.col("d.verdict") == "acceptable"), 1)).alias("acceptable"),
    )
    rate = F.round(F.coalesce(F.try_divide("acceptable", "required"), F.lit(0.0)), 6)
    return out.withColumn("acceptable_rate", rate).withColumn("passed", (F.col("missing") + F.col("unexpected") + F.col("duplicates") + F.col("critical_open") == 0) & (F.col("acceptable_rate") >= least_rate))


def quarantine(expected: DataFrame, decisions: DataFrame) -> DataFrame:
    return decisions.where("quarantine").select("trace_id").distinct().join(expected.select("trace_id"), "trace_id", "left_semi")


def gates(row: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row per named condition on a one-row report: gate, passed."""
    entries = F.array(*[F.struct(F.lit(n).alias("gate"), c.alias("passed")) for n, c in conditions.items()])
    return row.select(F.explode(entries).alias("e")).select("e.gate", "e.passed")


def changed(queue_rows: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Traces whose recorded score or reasons are not what they compute to."""
    b = recomputed.select("trace_id", F.col("risk_score").alias("score2"), F.array_join("reasons", ",").alias("reasons2"))
    a = queue_rows.select("trace_id", "risk_score", F.array_join("reasons", ",").alias("reasons1"))
    return a.join(b, "trace_id").where("risk_score <> score2 or reasons1 <> reasons2").select("trace_id", "risk_score", F.col("score2").alias("recomputed"))
