"""Completed curation records merged into source rows, by task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUL = "\x00"


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def _lacking(c: str) -> Column:
    return (_text(c) == "") | F.contains(F.coalesce(F.col(c), F.lit("")), F.lit(NUL))


def patch_errors(patch: str = "hidden_test_patch", commands: str = "hidden_test_commands", summary: str = "public_behavior_summary", notes: str = "withheld_evaluator_notes", hidden: tuple[str, ...] = ()) -> Column:
    """Codes of what is wrong with a curated test patch: its texts, its commands, and words that a public summary may not hold."""
    each = F.col(commands)
    bad = F.exists(each, lambda x: F.coalesce(F.trim(x) == "", F.lit(True)) | F.coalesce(F.contains(x, F.lit(NUL)), F.lit(False)))
    told = F.lower(F.coalesce(F.col(summary), F.lit("")))
    return F.array_compact(
        F.array(
            F.when(_lacking(summary), "public_behavior_summary"),
            *[F.when(F.contains(told, F.lit(w)), f"summary_holds:{w}") for w in hidden],
            F.when(_lacking(patch), "hidden_test_patch"),
            F.when(each.isNull() | (F.size(each) <= 0) | bad, "hidden_test_commands"),
            F.when(_lacking(notes), "withheld_evaluator_notes"),
        )
    )


def buckets(tasks: DataFrame, records: DataFrame, errors: Column | None = None) -> DataFrame:
    """record_index, task_id, bucket (applied, invalid, unused), reason and errors of every record.

    tasks: task_id, source_instance_id; records: record_index (distinct), task_id, source_instance_id and what ``errors`` reads. A
    task's first valid record is applied; those after it are doubles whatever they hold, those before it stay malformed. A
    task's records meet in one aggregation of a number each, so a task with very many records costs no memory. Cases: a blank
    task is invalid, one that no task has is unused; repeated tasks count once; a record must name its task's source.
    """
    plan = tasks.where(F.trim("task_id") != "").select(F.trim("task_id").alias("task_id"), F.trim(F.coalesce("source_instance_id", F.lit(""))).alias("_source")).dropDuplicates(["task_id"])
    own = _text("source_instance_id")
    r = records.withColumns({"task_id": _text("task_id"), "_errors": errors if errors is not None else F.array().cast("array<string>")})
    met = r.join(plan, "task_id", "left")
    source = F.when(own == "", F.array(F.lit("source_instance_id"))).when(own != F.col("_source"), F.array(F.lit("other_source_instance_id"))).otherwise(F.array().cast("array<string>"))
    met = met.withColumn("errors", F.concat(source, "_errors"))
    planned = (F.col("task_id") != "") & F.col("_source").isNotNull()
    first = met.where(planned & (F.size("errors") == 0)).groupBy("task_id").agg(F.min("record_index").alias("_first"))
    met = met.join(first, "task_id", "left")
    reason = (
        F.when(F.col("task_id") == "", "invalid:no_task")
        .when(F.col("_source").isNull(), "unused:unknown_task")
        .when(F.col("record_index") == F.col("_first"), "applied:")
        .when(F.col("record_index") > F.col("_first"), "invalid:double")
        .otherwise("invalid:malformed")
    )
    met = met.withColumn("_reason", reason)
    return met.select("record_index", "task_id", F.substring_index("_reason", ":", 1).alias("bucket"), F.substring_index("_reason", ":", -1).alias("reason"), F.when(F.col("_reason") == "invalid:malformed", F.col("errors")).otherwise(F.array().cast("array<string>")).alias("errors"))


def apply(tasks: DataFrame, sources: DataFrame, records: DataFrame, placed: DataFrame) -> DataFrame:
    """The source rows, those of a task with an applied record rewritten; all others unchanged, none dropped or doubled.

    sources: source_instance_id, test_patch, test_commands, verifier_types and any others; placed: the buckets of the
    records. A rewritten row has the record's patch and commands, ``hidden_test_patch`` among its verifier types, and
    ``curation_task_id`` with the patch's hash; of several tasks on one source the last by id counts.
    """
    good = records.join(placed.where("bucket = 'applied'").select("record_index", F.col("task_id").alias("curation_task_id")), "record_index")
    chosen = tasks.where("trim(task_id) <> '' and trim(source_instance_id) <> ''").groupBy(F.trim("source_instance_id").alias("_source")).agg(F.max(F.trim("task_id")).alias("curation_task_id"))
    new = chosen.join(good.select("curation_task_id", F.col("hidden_test_patch").alias("_patch"), F.col("hidden_test_commands").alias("_commands")), "curation_task_id")
    met = sources.join(new, F.trim(sources["source_instance_id"]) == F.col("_source"), "left")
    done = F.col("_patch").isNotNull()
    types = F.array_sort(F.array_union(F.coalesce("verifier_types", F.array().cast("array<string>")), F.array(F.lit("hidden_test_patch"))))
    changed = {
        "test_patch": F.when(done, F.col("_patch")).otherwise(F.col("test_patch")),
        "test_commands": F.when(done, F.transform("_commands", lambda x: F.trim(x))).otherwise(F.col("test_commands")),
        "verifier_types": F.when(done, types).otherwise(F.col("verifier_types")),
        "curation_task_id": F.when(done, F.col("curation_task_id")),
        "hidden_test_patch_sha256": F.when(done, F.sha2("_patch", 256)),
    }
    return met.withColumns(changed).drop("_patch", "_commands", "_source")


def remaining(tasks: DataFrame, placed: DataFrame) -> DataFrame:
    """Tasks without an applied record."""
    done = placed.where("bucket = 'applied'").select("task_id")
    return tasks.where(F.trim("task_id") != "").withColumn("task_id", F.trim("task_id")).dropDuplicates(["task_id"]).join(done, "task_id", "left_anti")


def absent(tasks: DataFrame, sources: DataFrame, placed: DataFrame) -> DataFrame:
    """source_instance_id of curated tasks that no source row has."""
    done = placed.where("bucket = 'applied'").select("task_id")
    named = tasks.select(F.trim("task_id").alias("task_id"), F.trim("source_instance_id").alias("source_instance_id")).where("source_instance_id <> ''")
    return named.join(done, "task_id", "left_semi").select("source_instance_id").distinct().join(sources.select(F.trim("source_instance_id").alias("source_instance_id")), "source_instance_id", "left_anti")


def summary(tasks: DataFrame, sources: DataFrame, placed: DataFrame) -> DataFrame:
    """One row: how many records went where, what remains, and whether the result is valid and ready."""
    counts = placed.agg(*[F.count(F.when(F.col("bucket") == b, 1)).alias(b) for b in ("applied", "invalid", "unused")])
    out = counts.join(F.broadcast(remaining(tasks, placed).agg(F.count("*").alias("remaining")))).join(F.broadcast(absent(tasks, sources, placed).agg(F.count("*").alias("absent_sources"))))  # one row each
    valid = (F.col("invalid") == 0) & (F.col("absent_sources") == 0)
    return out.select("*", valid.alias("valid"), (valid & (F.col("applied") > 0)).alias("ready"))
