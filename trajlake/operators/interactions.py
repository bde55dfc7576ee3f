"""Figures of conversations with a user: what was asked, answered, disclosed and reached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of user actions and flags of a turn that are counted, with the names of their counts.
ACTIONS = {"clarify": "clarifications", "correct": "corrections", "refuse": "refusals", "confirm": "confirmations"}
FLAGS = ("contradictions", "early_stops", "disclosure_violations", "unavailable_fact_requests", "unavailable_fact_leaks", "critical_simulator_errors")


def interaction_metrics(turns: DataFrame, goals: DataFrame) -> DataFrame:
    """One row per session: counts of actions and flags, diversity of responses, goal alignment and error rate.

    turns: session_id, action (null where the user did nothing), response (null where there is none) and a boolean of each of
    ``FLAGS``; goals: session_id, component and satisfied, a component counting once and as satisfied if any row says so. Diversity is distinct over
    all responses, 0 without any; alignment is 1 where a session has no goals; the error rate is by turn. Goals of sessions without turns have no row.
    """

    def n(when: Column) -> Column:
        return F.count(F.when(when, 1))

    each = turns.groupBy("session_id").agg(
        F.count("*").alias("turns"), *[n(F.col("action") == a).alias(c) for a, c in ACTIONS.items()], *[n(F.col(c)).alias(c) for c in FLAGS], F.count("response").alias("responses"), F.count_distinct("response").alias("_distinct")
    )
    parts = goals.groupBy("session_id", "component").agg(F.max(F.coalesce("satisfied", F.lit(False))).alias("ok"))
    reached = parts.groupBy("session_id").agg(F.count("*").alias("goal_components_total"), n(F.col("ok")).alias("goal_components_satisfied"))
    met = each.join(reached, "session_id", "left")
    total, done = (F.coalesce(f"goal_components_{k}", F.lit(0)) for k in ("total", "satisfied"))

    def share(a: Column, b: Column, otherwise: float) -> Column:
        return F.round(F.coalesce(F.try_divide(a, b), F.lit(otherwise)), 6)

    return met.select(
        "session_id", "turns", *ACTIONS.values(), *FLAGS, "responses", total.alias("goal_components_total"), done.alias("goal_components_satisfied"), share(F.col("_distinct"), F.col("responses"), 0.0).alias("diversity"), share(done, total, 1.0).alias("goal_alignment"),
        share(F.col("critical_simulator_errors"), F.col("turns"), 0.0).alias("simulator_error_rate"),
    )


def disclosures(messages: DataFrame, names: list[str], conversation: str = "conv_id", order: str = "turn", text: str = "text") -> DataFrame:
    """Per message, name and whether it is unasked: facts whose name a message holds, whatever the case, and whether the message before it does not.

    Cases: a null text holds nothing; the first message was asked for nothing; blank names take no part.
    """
    before = F.lag(text).over(Window.partitionBy(conversation).orderBy(order))
    told = [n.lower() for n in names if n.strip()]
    each = F.array(*[F.struct(F.lit(n).alias("name"), F.contains(F.lower(F.coalesce(F.col("_before"), F.lit(""))), F.lit(n)).alias("asked")) for n in told]) if told else F.array().cast("array<struct<name:string,asked:boolean>>")
    said = F.filter(each, lambda x: F.contains(F.lower(F.coalesce(F.col(text), F.lit(""))), x["name"]))
    return messages.withColumn("_before", before).select(conversation, order, F.explode(said).alias("x")).select(conversation, order, "x.name", (~F.col("x.asked")).alias("unasked"))
