"""Plans of what to collect next: preflight and readiness of a collection, remediation of reserved slots, missing evidence of drafted specs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.text import label
from trajlake.operators.jobs import numbered
from trajlake.operators.source_records import public_kind

#: Sources that a collector exists for.
SUPPORTED = ("issues", "pull_requests", "ci")


def selected_tasks(tasks: DataFrame, offset: int = 0, most: int | None = None) -> DataFrame:
    """Tasks of a page with their index, from 0, in order of ``position``; numbered by ranges, not in one task."""
    placed = numbered(tasks, "position", "_rn").withColumn("task_index", F.col("_rn") - 1).drop("_rn")
    page = F.col("task_index") >= max(0, offset)
    return placed.where(page if most is None else page & (F.col("task_index") < max(0, offset) + max(0, most)))


def preflight_issues(plan: DataFrame, tasks: DataFrame, files: DataFrame, *, offset: int = 0, most: int | None = None, token_required: bool = False, token_given: bool = False, source_required: bool = False) -> DataFrame:
    """code, task_index, repository and file of what stands in the way of a collection, before it begins.

    plan: one row (valid, total_tasks) or none; tasks: position (distinct), collection_source, repository; files: path, role
    (source or summary), present, and readable (source: its lines are records; summary: one JSON object). A path that
    the caller asked for is a row, whether it is there or not. Cases: no plan row is an invalid plan and nothing else is
    looked at; a total of null or 0 counts the tasks; null flags count as false.
    """
    page = selected_tasks(tasks, offset, most)
    kind = label("collection_source")
    known = plan.agg(F.count("*").alias("plans"), F.coalesce(F.max(F.coalesce("valid", F.lit(False))), F.lit(False)).alias("plan_valid"), F.max("total_tasks").alias("said"))
    whole = known.join(F.broadcast(tasks.agg(F.count("*").alias("n")))).join(F.broadcast(page.agg(F.count("*").alias("picked"))))  # one row each
    total = F.when(F.coalesce("said", F.lit(0)) == 0, F.col("n")).otherwise(F.col("said"))
    only = F.col("plans") > 0
    codes = F.array_compact(
        F.array(
            F.when(~only | ~F.col("plan_valid"), "source_collection_plan_invalid"),
            F.when(only & (total <= 0), "missing_collection_plan_tasks"),
            F.when(only & (F.col("picked") == 0), "no_selected_collection_tasks"),
            F.when(only & F.lit(token_required and not token_given), "missing_token"),
        )
    )
    none = F.lit(None).cast("long").alias("task_index"), F.lit(None).cast("string").alias("repository"), F.lit(None).cast("string").alias("file")
    general = whole.select(F.explode(codes).alias("code"), *none)
    odd = page.where(~F.coalesce(kind.isin(*SUPPORTED), F.lit(False))).select(F.lit("unsupported_collection_task").alias("code"), "task_index", F.trim("repository").alias("repository"), F.lit(None).cast("string").alias("file"))
    there, good = F.coalesce("present", F.lit(False)), F.coalesce("readable", F.lit(False))
    source, summary = F.col("role") == "source", F.col("role") == "summary"
    of_file = F.when(source & ~there & F.lit(source_required), "missing_source_records").when(source & there & ~good, "source_records_invalid").when(summary & ~there, "missing_collection_summary").when(summary & there & ~good, "collection_summary_invalid")
    unread = files.select(of_file.alias("code"), none[0], none[1], F.col("path").alias("file")).where("code is not null")
    known_plan = F.broadcast(plan.limit(1).select(F.lit(1).alias("_p")))
    return general.unionByName(odd.unionByName(unread).join(known_plan).drop("_p"))


def preflight_summary(tasks: DataFrame, issues: DataFrame, *, offset: int = 0, most: int | None = None) -> DataFrame:
    """One row: tasks selected, those of a supported source, issues, and whether the collection may begin."""
    page = selected_tasks(tasks, offset, most)
    some = page.agg(F.count("*").alias("selected_tasks"), F.count(F.when(label("collection_source").isin(*SUPPORTED), 1)).alias("supported_tasks"))
    return some.join(F.broadcast(issues.agg(F.count("*").alias("issues")))).withColumn("ready", F.col("issues") == 0)


def readiness(plan: DataFrame, tasks: DataFrame, export: DataFrame, audit: DataFrame, accepted: DataFrame, *, least_accepted: int = 1, most_quarantined: int = 0, clean_export: bool = False, all_tasks: bool = False, source_types: tuple[str, ...] = ()) -> DataFrame:
    """code, severity and detail: thirteen conditions that a collection must meet before it is imported.

    plan, export and audit hold one row each (plan: valid, total_tasks; export: valid, plan_tasks, selected_tasks, skipped_tasks, exported, issues (a
    number); audit: valid, total, accepted, quarantined); tasks: collection_source; accepted: source_type of accepted
    records. Cases: a summary without a row is invalid and all its numbers are 0, as are null ones.
    """

    def number(c: str) -> Column:
        return F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))), F.lit(0)).cast("long")

    def sound(name: str) -> Column:
        return F.coalesce(F.max(F.col("valid")), F.lit(False)).alias(name)

    p = plan.agg(sound("plan_valid"), number("total_tasks").alias("said"))
    t = tasks.agg(F.count("*").alias("n"), F.count(F.when(label("collection_source").isin(*SUPPORTED), 1)).alias("supported"))
    e = export.agg(sound("export_valid"), *[number(c).alias(f"e_{c}") for c in ("plan_tasks", "selected_tasks", "skipped_tasks", "exported", "issues")])
    a = audit.agg(sound("audit_valid"), *[number(c).alias(f"a_{c}") for c in ("total", "accepted", "quarantined")])
    source_types = tuple(sorted(set(source_types)))
    wanted = F.array_distinct(F.array(*[public_kind(F.lit(k)) for k in source_types])) if source_types else F.array().cast("array<string>")
    types = accepted.select(public_kind(F.col("source_type")).alias("t")).where("t <> ''").agg(F.collect_set(F.when(F.array_contains(wanted, F.col("t")), F.col("t"))).alias("present"))
    row = p.join(F.broadcast(t)).join(F.broadcast(e)).join(F.broadcast(a)).join(F.broadcast(types))  # one row each
    row = row.withColumn("planned", F.when(F.col("said") == 0, F.col("n")).otherwise(F.col("said")))

    def found(when: Column, code: str, severity: str = "error", detail: Column | None = None) -> Column:
        return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), (F.lit("") if detail is None else detail).alias("detail")))

    def against(c: str, other) -> Column:
        return F.concat_ws(" ", F.col(c).cast("string"), F.lit("against"), other.cast("string") if isinstance(other, Column) else F.lit(str(other)))

    checks = [
        found(~F.col("plan_valid"), "source_collection_plan_invalid"),
        found(F.col("planned") <= 0, "missing_collection_plan_tasks"),
        found(F.col("supported") <= 0, "missing_supported_collection_tasks"),
        found(~F.col("export_valid"), "source_export_summary_invalid"),
        found(~F.col("audit_valid"), "source_collection_audit_failed"),
        found(F.col("a_accepted") < max(0, least_accepted), "accepted_records_below_minimum", detail=against("a_accepted", max(0, least_accepted))),
        found(F.col("a_quarantined") > max(0, most_quarantined), "quarantine_budget_exceeded", detail=against("a_quarantined", max(0, most_quarantined))),
        found(F.col("e_exported") != F.col("a_total"), "audit_export_count_mismatch", detail=against("a_total", F.col("e_exported"))),
        found((F.col("e_plan_tasks") != 0) & (F.col("planned") != 0) & (F.col("e_plan_tasks") != F.col("planned")), "plan_export_task_count_mismatch", detail=against("planned", F.col("e_plan_tasks"))),
        found(F.lit(all_tasks) & (F.col("e_selected_tasks") < F.col("planned")), "partial_plan_selection", detail=against("e_selected_tasks", F.col("planned"))),
        *[found(~F.array_contains("present", public_kind(F.lit(k))), "missing_required_source_type", detail=F.lit(k)) for k in source_types],
        found(F.col("e_issues") > 0, "source_export_issues", "error" if clean_export else "warning", F.col("e_issues").cast("string")),
        found(F.col("e_skipped_tasks") != 0, "skipped_collection_tasks", "warning", F.col("e_skipped_tasks").cast("string")),
    ]
    return row.select(F.explode(F.array_compact(F.array(*checks))).alias("x")).select("x.code", "x.severity", "x.detail")


# --- remediation of reserved slots

#: Action of a slot by its type and target; the first rule that fits counts, the last fits all.
_RULES = (
    ("share_cap_diversity", "language", "collect_cross_language_sources"),
    ("share_cap_diversity", "repository", "collect_non_dominant_repository_sources"),
    ("share_cap_diversity", None, "collect_share_cap_diversity_sources"),
    ("source_method_minimum", "public_issue_workspace", "collect_public_issue_sources"),
    ("verifier_type_minimum", "build_command", "collect_build_command_evidence"),
    ("verifier_type_minimum", "hidden_test_patch", "curate_hidden_test_patch_evidence"),
    (None, None, "satisfy_reserved_backfill_slot"),
)


def remediation(slots: DataFrame) -> DataFrame:
    """The slots with their action. slots: slot_id, type, target, dimension, dominant_label, minimum_count; of share caps the dimension is looked at, of others the target."""
    kind = F.coalesce("type", F.lit(""))
    what = F.when(kind == "share_cap_diversity", F.coalesce("dimension", F.lit(""))).otherwise(F.coalesce("target", F.lit("")))
    action = F.lit(None).cast("string")
    for of, target, name in reversed(_RULES):
        fits = (F.lit(True) if of is None else kind == of) & (F.lit(True) if target is None else what == target)
        action = F.when(fits, F.lit(name)).otherwise(action)
    return slots.select("slot_id", kind.alias("type"), F.coalesce("target", F.lit("")).alias("target"), F.coalesce("dominant_label", F.lit("")).alias("dominant_label"), F.coalesce("minimum_count", F.lit(0)).alias("minimum_count"), action.alias("action"))


def remediation_candidates(planned: DataFrame, allowlist: DataFrame) -> DataFrame:
    """action, repository and slots: from where sources may be collected, and for how many of the action's slots.

    Slots for other languages take the repositories of languages other than Python, slots for other repositories all but a slot's dominant one:
    a repository counts for the action's slots less those that it dominates, so slots and repositories are never crossed. Cases: blank
    repositories take no part; one of no known language is no candidate for a language; what no slot may use has no row.
    """
    allowed = allowlist.select(F.trim(F.coalesce("repository", F.lit(""))).alias("repository"), label("language").alias("language")).where("repository <> ''").distinct()
    wide = planned.where("action = 'collect_cross_language_sources'").groupBy("action").agg(F.count("*").alias("slots"))  # at most one row
    rest = planned.where("action = 'collect_non_dominant_repository_sources'")
    all_of = rest.groupBy("action").agg(F.count("*").alias("_all"))  # at most one row
    dominated = rest.groupBy(F.col("dominant_label").alias("repository")).agg(F.count("*").alias("_own"))
    other = allowed.where("language <> '' and language <> 'python'").select("repository").distinct().join(F.broadcast(wide)).select("action", "repository", "slots")
    names = allowed.select("repository").distinct().join(F.broadcast(all_of)).join(dominated, "repository", "left")
    left = names.select("action", "repository", (F.col("_all") - F.coalesce("_own", F.lit(0))).alias("slots")).where("slots > 0")
    return other.unionByName(left)


def remediation_issues(planned: DataFrame, allowlist: DataFrame) -> DataFrame:
    """code and severity of what keeps the slots from being filled; one row of counts decides."""
    repository = F.trim(F.coalesce("repository", F.lit("")))
    language = label("language")
    a = allowlist.agg(F.count("*").alias("rows"), F.count(F.when((repository != "") & (language != "") & (language != "python"), 1)).alias("other"), F.count_distinct(F.when(repository != "", repository)).alias("names"), F.min(F.when(repository != "", repository)).alias("least"))
    s = planned.join(F.broadcast(a))  # one row
    alone = (F.col("action") == "collect_non_dominant_repository_sources") & ((F.col("names") == 0) | ((F.col("names") == 1) & (F.col("least") == F.col("dominant_label"))))
    counts = s.agg(F.count("*").alias("slots"), F.count(F.when(alone, 1)).alias("alone")).join(F.broadcast(a))
    given = (F.col("slots") > 0) & (F.col("rows") > 0)
    found = [
        (given & (F.col("other") == 0), "missing_cross_language_allowlist_candidate", "error"),
        (given & (F.col("alone") > 0), "missing_non_dominant_repository_candidate", "error"),
        ((F.col("slots") > 0) & (F.col("rows") == 0), "allowlist_not_provided", "warning"),
        (F.col("slots") == 0, "no_reserved_backfill_slots", "warning"),
    ]
    each = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for when, code, severity in found]))
    return counts.select(F.explode(each).alias("x")).select("x.code", "x.severity")


# --- missing evidence of drafted specs


def missing_evidence(specs: DataFrame) -> DataFrame:
    """A row per spec, family and target whose evidence is missing, with the kind that is missing and an id.

    specs: spec_id, repository, source_revision, task_families (a list; none counts as "unknown"), targets (a list of structs with name, doctest_commands, example_commands,
    benchmark_commands, performance_threshold (a map); null is the spec itself, an empty list no target) and the spec's own fields of these names, which
    count for all its targets. Documentation needs a doctest or an example, performance a benchmark or a threshold; no other family lacks anything.
    """
    own = F.struct(F.lit("").alias("name"), *[F.array().cast("array<string>").alias(c) for c in ("doctest_commands", "example_commands", "benchmark_commands")], F.create_map().cast("map<string,double>").alias("performance_threshold"))
    families = F.when(F.size(F.coalesce("task_families", F.array().cast("array<string>"))) > 0, F.col("task_families")).otherwise(F.array(F.lit("unknown")))
    each = specs.withColumn("targets", F.coalesce("targets", F.array(own))).withColumn("task_family", F.explode(families)).withColumn("task_family", label("task_family"))
    each = each.withColumn("target", F.explode("targets"))

    def any_of(c: str) -> Column:
        def some(v: Column) -> Column:
            return F.coalesce(F.exists(v, lambda x: F.coalesce(F.trim(x) != "", F.lit(False))), F.lit(False))

        return some(F.col(c)) | some(F.col("target")[c])

    limit = (F.coalesce(F.size("performance_threshold"), F.lit(0)) > 0) | (F.coalesce(F.size(F.col("target")["performance_threshold"]), F.lit(0)) > 0)
    missing = F.when((F.col("task_family") == "docs_examples") & ~(any_of("doctest_commands") | any_of("example_commands")), "doctest_or_example_command").when((F.col("task_family") == "performance") & ~(any_of("benchmark_commands") | limit), "benchmark_command_or_performance_threshold")
    name = F.coalesce(F.col("target")["name"], F.lit(""))
    named = F.concat_ws("|", F.coalesce("repository", F.lit("")), F.coalesce("source_revision", F.lit("")), F.col("task_family"), name)
    return each.select(F.concat(F.lit("evidence_"), F.substring(F.sha2(named, 256), 1, 16)).alias("evidence_task_id"), "spec_id", "repository", "task_family", name.alias("target_name"), missing.alias("missing")).where("missing is not null")


def evidence_counts(missing: DataFrame) -> DataFrame:
    """dimension (task_family or missing), label and tasks."""
    sides = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("label")) for c in ("task_family", "missing")])
    return missing.select(F.explode(sides).alias("x")).groupBy("x.dimension", "x.label").agg(F.count("*").alias("tasks"))


def evidence_templates(missing: DataFrame, schedule: DataFrame) -> DataFrame:
    """A row per task that a shard is to fill: shard_id, evidence_task_id, fields, and outcome (template, or absent where the plan has no such task).

    schedule: shard_id, evidence_task_ids. Cases: a shard without tasks has no rows; a task in several shards is one of each.
    """
    asked = schedule.select("shard_id", F.explode("evidence_task_ids").alias("evidence_task_id")).where("evidence_task_id <> ''")
    plan = missing.dropDuplicates(["evidence_task_id"]).select("evidence_task_id", "repository", "task_family", "target_name", "missing")
    fields = F.when(F.col("missing") == "doctest_or_example_command", "doctest_commands,example_commands").when(F.col("missing").isNotNull(), "benchmark_commands,performance_threshold")
    return asked.join(plan, "evidence_task_id", "left").select("shard_id", "evidence_task_id", "repository", "task_family", "target_name", fields.alias("fields"), F.when(F.col("missing").isNull(), "absent").otherwise("template").alias("outcome"))


def first_of_shards(tasks: DataFrame, size: int) -> DataFrame:
    """shard_id and evidence_task_ids: ``size`` tasks a shard in order of their id, numbered by ranges."""
    placed = numbered(tasks.select("evidence_task_id").distinct(), "evidence_task_id")
    shard = F.concat(F.lit("shard_"), F.lpad(F.floor((F.col("rn") - 1) / size).cast("string"), 6, "0"))
    return placed.groupBy(shard.alias("shard_id")).agg(F.array_sort(F.collect_list("evidence_task_id")).alias("evidence_task_ids"))


def evidence_shard_states(shards: DataFrame, artifacts: DataFrame, tasks: DataFrame, records: DataFrame, applied: DataFrame) -> DataFrame:
    """State and next action of each shard of missing evidence: shard_id, status, next_action, records, matching, absent, extra and remaining.

    shards: shard_id, selected_tasks; artifacts: shard_id, kind (template, records, apply, spec), state (present, missing or invalid) and, of an apply,
    valid and remaining, of a spec, repositories; a kind without a row is missing. tasks, records, applied: shard_id and evidence_task_id of
    what a shard selected, of its records and of those applied. Each side is brought to a number a shard where it lies; ids meet in one
    aggregation by shard and id. Cases: repeated ids count once, but every record counts as one; blank ids belong to no task; a
    shard without tasks takes what the apply says that remains.
    """
    sides = [(tasks, "t"), (records, "r"), (applied, "a")]
    stacked = None
    for df, side in sides:
        one = df.select("shard_id", F.coalesce("evidence_task_id", F.lit("")).alias("id"), F.lit(side).alias("side"))
        stacked = one if stacked is None else stacked.unionByName(one)

    def has(side: str) -> Column:
        return F.count(F.when(F.col("side") == side, 1)) > 0

    ids = stacked.groupBy("shard_id", "id").agg(has("t").alias("t"), has("r").alias("r"), has("a").alias("a"), F.count(F.when(F.col("side") == "r", 1)).alias("n"))
    named = F.col("id") != ""

    def n(when: Column) -> Column:
        return F.count(F.when(named & when, 1))

    t, r, a = F.col("t"), F.col("r"), F.col("a")
    by = ids.groupBy("shard_id").agg(F.sum("n").alias("records"), n(t).alias("tasks"), n(t & r).alias("matching"), n(t & ~r).alias("absent"), n(r & ~t).alias("extra"), n(t & ~a).alias("left"))

    def of(kind: str, c: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(c)))

    files = artifacts.groupBy("shard_id").agg(*[of(k, "state").alias(k) for k in ("template", "records", "apply", "spec")], of("apply", "valid").alias("valid"), of("apply", "remaining").alias("said"), of("spec", "repositories").alias("repositories"))
    files = files.withColumnRenamed("records", "file")
    met = shards.select("shard_id", F.coalesce("selected_tasks", F.lit(0)).alias("selected")).join(files, "shard_id", "left").join(by, "shard_id", "left")
    met = met.withColumns({**{k: F.coalesce(k, F.lit("missing")) for k in ("template", "file", "apply", "spec")}, **{k: F.coalesce(k, F.lit(0)) for k in ("records", "tasks", "matching", "absent", "extra", "left", "said", "repositories")}, "valid": F.coalesce("valid", F.lit(False))})
    over = F.when(F.col("tasks") > 0, F.col("left")).otherwise(F.col("said"))
    state = (
        F.when((F.col("file") == "missing") & (F.col("template") == "invalid"), "blocked:fix_evidence_template")
        .when((F.col("file") == "missing") & (F.col("template") == "present"), "pending:fill_evidence_template")
        .when(F.col("file") == "missing", "pending:collect_evidence")
        .when(F.col("file") == "invalid", "blocked:fix_evidence_records")
        .when(F.col("apply") == "missing", "ready_to_apply:apply_evidence")
        .when(F.col("apply") == "invalid", "blocked:inspect_apply_output")
        .when(~F.col("valid"), "blocked:resolve_apply_errors")
        .when(over > 0, "partial:collect_remaining_evidence")
        .when(F.col("spec") == "missing", "ready_to_finalize:write_spec_output")
        .when((F.col("spec") == "invalid") | (F.col("repositories") <= 0), "blocked:fix_spec_output")
        .otherwise("complete:none")
    )
    read = F.col("file") == "present"
    applied_at_all = read & ~F.col("apply").isin("missing", "invalid")
    left = F.when(~read | (F.col("apply") == "missing"), F.col("selected")).when(F.col("apply") == "invalid", 0).otherwise(over)
    shown = {c: F.when(read, F.col(c)).otherwise(F.lit(0)).cast("long") for c in ("records", "matching", "extra")}
    return met.withColumn("_state", state).select(
        "shard_id", F.substring_index("_state", ":", 1).alias("status"), F.substring_index("_state", ":", -1).alias("next_action"), *[c.alias(k) for k, c in shown.items()], F.when(read, F.col("absent")).otherwise(F.col("tasks")).cast("long").alias("absent"), F.when(applied_at_all, over).otherwise(left).cast("long").alias("remaining")
    )
