"""Public source records: classification, checks, allowlists, acceptance, collection plans and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.fields import normal_label, normal_source

# Licences that training data may have, as normalised labels.
LICENSES = ("0bsd", "apache_2.0", "bsd_2_clause", "bsd_3_clause", "cc0_1.0", "isc", "mit", "mpl_2.0", "python_2.0", "unlicense")


def source_type(c: Column, default: str = "public_issue") -> Column:
    """Kind of a record from its label; a blank one gives the default."""
    return F.when(c == "pull_request", "public_pull_request").when(c == "ci_run", "public_ci").when(c == "issue", "public_issue").otherwise(default)


def license_ok(c: Column) -> Column:
    """Whether a licence, however it is spelled, is one of those; a blank or missing one is not."""
    return normal_label(c).isin(*LICENSES)


def issues(records: DataFrame) -> DataFrame:
    """position and code of every failed check of a record."""
    checks = F.array_compact(
        F.array(
            F.when(F.col("source_instance_id") == "", "missing_instance_id"),
            F.when(F.col("title") == "", "missing_title"),
            F.when(~F.col("revision").rlike("^[0-9a-f]{40}$"), "revision_not_fixed"),
            F.when(F.col("license") == "", "missing_license").when(~license_ok(F.col("license")), "license_not_allowed"),
            F.when(~F.col("source_url").rlike("^https://"), "url_not_https"),
            F.when(F.col("source_type") == "", "missing_source_type"),
        )
    )
    return records.select("position", F.explode(checks).alias("code"))


def allowlist_issues(allowlist: DataFrame, benchmarks: tuple[str, ...] = ()) -> DataFrame:
    """position, repository and code of every check that a repository on the list fails; approved are those without a row.

    allowlist: position, repository, benchmark_overlap, source_uri, license, language, collection_sources,
    test_commands, ci_commands. Null counts as missing.
    """
    repository = normal_source(F.col("repository"))
    uri = F.trim(F.coalesce("source_uri", F.lit("")))
    host = F.lower(F.regexp_extract(uri, r"^https://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    public = uri.startswith("file:") | (uri.startswith("https://") & host.contains(".") & (host != "127.0.0.1"))

    def none(c: str) -> Column:
        return F.coalesce(F.size(F.filter(c, lambda x: F.trim(x) != "")), F.lit(0)) <= 0

    checks = F.array_compact(
        F.array(
            F.when(repository == "", "missing_repository"),
            F.when(repository.isin(*[b.lower() for b in benchmarks], "\x00") | F.coalesce("benchmark_overlap", F.lit(False)), "benchmark_overlap"),
            F.when(uri == "", "missing_source_uri").when(~public, "non_public_source_uri"),
            F.when(normal_label(F.col("license")) == "", "missing_license").when(~license_ok(F.col("license")), "license_not_allowlisted"),
            F.when(normal_label(F.col("language")) == "", "missing_language"),
            F.when(none("collection_sources"), "missing_collection_source"),
            F.when(none("test_commands") & none("ci_commands"), "missing_stable_command"),
        )
    )
    return allowlist.select("position", repository.alias("repository"), F.explode(checks).alias("code"))


def first_rejection(records: DataFrame) -> DataFrame:
    """The first rule that rejects a record, in order; empty if none does."""
    code = (
        F.when(F.col("source_type") == "ci_run", "source_type")
        .when((F.col("source_instance_id") == "") | (F.col("title") == ""), "missing_fields")
        .when(~F.col("revision").rlike("^[0-9a-f]{40}$"), "revision")
        .when(F.lower("title").contains("benchmark"), "benchmark_source")
        .when(~F.col("has_verifier"), "no_oracle")
        .otherwise("")
    )
    return records.select("position", code.alias("rejection_code"))


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")


def allowlist_filter(records: DataFrame, allowlist: DataFrame) -> DataFrame:
    """position and reason ("" where allowed): repository unknown, its license refused, or the record's license refused."""
    known = latest(allowlist, "repository", "position").select("repository", F.col("license").alias("allow_license"))
    met = records.join(known, "repository", "left")
    reason = F.when(F.col("allow_license").isNull(), "repository_not_allowlisted").when(~license_ok(F.col("allow_license")), "repository_license").when(~license_ok(F.col("license")), "record_license").otherwise("")
    return met.select("position", reason.alias("reason"))


def accepted(records: DataFrame, allowlist: DataFrame) -> DataFrame:
    """Records that are allowlisted, without a failed check and the first of their instance id."""
    reason = allowlist_filter(records, allowlist).where("reason = ''").select("position")
    failed = issues(records).select("position").distinct()
    place = F.row_number().over(Window.partitionBy("source_instance_id").orderBy("position"))
    first = records.withColumn("_n", place).where("_n = 1").drop("_n")
    return first.join(reason, "position", "left_semi").join(failed, "position", "left_anti")


def audit(records: DataFrame, allowlist: DataFrame) -> DataFrame:
    """Counts per source type: records, accepted, distinct repositories."""
    yes = accepted(records, allowlist).select("position", F.lit(1).alias("yes"))
    return records.join(yes, "position", "left").groupBy(source_type(F.col("source_type")).alias("source_type")).agg(F.count("*").alias("records"), F.count("yes").alias("accepted"), F.countDistinct("repository").alias("repositories"))


def task_family(records: DataFrame) -> DataFrame:
    """Family by the first rule that a title's tokens meet; performance needs a verifier."""
    t = F.regexp_extract_all(F.lower("title"), F.lit("[a-z0-9]+"), 0)

    def any_of(*names: str) -> Column:
        return F.arrays_overlap(t, F.array(*[F.lit(n) for n in names]))

    family = (
        F.when(any_of("slow", "performance", "benchmark") & F.col("has_verifier"), "performance")
        .when(any_of("docs", "typo"), "docs_examples")
        .when(any_of("refactor", "cleanup"), "refactor")
        .when(any_of("add", "feature"), "feature")
        .when(F.col("source_type") == "pull_request", "code_review")
        .otherwise("bug_repair")
    )
    return records.select("position", family.alias("task_family"))


def identity(c: Column) -> Column:
    """host, section and number of a page URL, or null where it is no such URL."""
    shape = r"^https?://([^/?#]+)/([a-z]{2})/([0-9]+)(?:[/.?#].*)?$"
    return F.when(c.rlike(shape), F.concat_ws("#", F.regexp_extract(c, shape, 1), F.regexp_extract(c, shape, 2), F.regexp_extract(c, shape, 3)))


def split_by_type(records: DataFrame, include: list[str], exclude: list[str]) -> DataFrame:
    """Records of the included types and not of the excluded ones; none at all if the two overlap."""
    if set(include) & set(exclude):
        return records.limit(0)
    kind = source_type(F.col("source_type"))
    return records.where(kind.isin(*include) & ~kind.isin(*exclude) if exclude else kind.isin(*include))


def workspaces(records: DataFrame, most: int = 5) -> DataFrame:
    """Per repository and revision: records, distinct types, and the first ids."""
    keyed = records.where("source_instance_id <> ''")
    place = F.dense_rank().over(Window.partitionBy("repository", "revision").orderBy("source_instance_id"))
    return keyed.withColumn("_n", place).groupBy("repository", "revision").agg(
        F.count("*").alias("records"), F.countDistinct("source_type").alias("types"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("_n") <= most, F.col("source_instance_id")))), ",").alias("first_ids")
    )


def append_new(existing: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Existing rows, then of the new ones the first of every key not seen."""
    first = new.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")
    return existing.unionByName(first.join(existing.select(key), key, "left_anti"))


def retry_tasks(tasks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Tasks to run again with the first reason: a failed outcome, none at all, or not selected."""
    met = tasks.join(outcomes, "task_id", "left")
    reason = F.when(F.col("status") == "failed", "failed").when(F.col("status").isNull() & F.col("selected"), "missing_outcome").when(~F.col("selected"), "not_selected")
    return met.select("task_id", reason.alias("reason")).where("reason is not null")


def merged_outcomes(outcomes: DataFrame) -> DataFrame:
    """Last outcome of every task and the counts it leaves, per status."""
    return latest(outcomes, "task_id", "shard").groupBy("status").agg(F.count("*").alias("tasks"), F.sum("new_records").alias("new_records"))


def next_action(shards: DataFrame) -> DataFrame:
    """State of a shard and what to do, from its preflight and export."""
    state = (
        F.when(F.col("preflight") == "invalid", "invalid")
        .when(F.col("export") == "complete", "complete")
        .when(F.col("export") == "partial", "partial")
        .when(F.col("preflight") == "blocked", "blocked")
        .otherwise("pending")
    )
    action = F.when(F.col("state") == "complete", "none").when(F.col("state") == "partial", "retry").when(F.col("state").isin("blocked", "invalid"), "fix_preflight").otherwise("run_export")
    return shards.select("shard_id", state.alias("state")).select("shard_id", "state", action.alias("next_action"))


def assembly(selected: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per selected seed: missing, duplicated or copied, by the number of its scenarios."""
    counts = scenarios.groupBy("seed_id").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return selected.select("seed_id").distinct().join(counts, "seed_id", "left").select("seed_id", F.when(n == 0, "missing").when(n > 1, "duplicated").otherwise("copied").alias("outcome"))


def evidence(tasks: DataFrame, records: DataFrame) -> DataFrame:
    """Records of evidence by what becomes of them: the first of a task counts, later ones and unknown ones do not."""
    place = F.row_number().over(Window.partitionBy("task_id").orderBy("position"))
    met = records.withColumn("_n", place).join(tasks.select("task_id", F.lit(True).alias("known")), "task_id", "left")
    outcome = F.when(F.col("known").isNull(), "unused").when(F.col("_n") > 1, "duplicate").when(~F.col("complete"), "incomplete").otherwise("applied")
    return met.select("task_id", "position", outcome.alias("outcome"))


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys on one side only, or whose columns differ: key, difference."""
    a = left.select(key, *[F.col(c).alias(f"l_{c}") for c in columns], F.lit(1).alias("in_left"))
    b = right.select(key, *[F.col(c).alias(f"r_{c}") for c in columns], F.lit(1).alias("in_right"))
    differs = F.array_join(F.array_compact(F.array(*[F.when(~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), c) for c in columns])), ",") if columns else F.lit("")
    what = F.when(F.col("in_right").isNull(), "missing").when(F.col("in_left").isNull(), "unexpected").otherwise(differs)
    return a.join(b, key, "full_outer").select(key, what.alias("difference")).where("difference <> ''")


def waivers(findings: DataFrame, declared: DataFrame) -> DataFrame:
    """Findings and declared waivers resolved: waived warnings, errors that none may waive, waivers without a finding."""
    met = findings.join(declared.withColumn("declared", F.lit(1)), ["code", "entry"], "full_outer")
    outcome = F.when(F.col("severity").isNull(), "unmatched_waiver").when(F.col("declared").isNull(), "open").when(F.col("severity") == "warning", "waived").otherwise("not_waivable")
    return met.select("code", "entry", outcome.alias("outcome"))


def round_robin_slots(slots: int, snapshots: DataFrame, order: str) -> DataFrame:
    """Slot i gets snapshot i mod n of the snapshots in order; none if there are none."""
    spark = snapshots.sparkSession
    ranked = snapshots.select(order, (F.row_number().over(Window.orderBy(order)) - 1).cast("long").alias("rank"))  # a list of repositories, small
    n = ranked.agg(F.count("*").alias("n"))
    wanted = spark.range(slots).withColumnRenamed("id", "slot").join(F.broadcast(n)).where("n > 0").withColumn("rank", F.col("slot") % F.col("n"))
    return wanted.join(F.broadcast(ranked), "rank").select("slot", order)


def scenarios(records: DataFrame, limit: int) -> DataFrame:
    """Records as scenarios, or the first problem of each; the limit counts successes only."""
    problem = F.when(F.col("source_instance_id") == "", "missing instance id").when(F.col("title") == "", "missing query").when(~F.col("revision").rlike("^[0-9a-f]{40}$"), "revision is not fixed").otherwise("")
    judged = records.withColumn("issue", problem)
    # ids are ascending: only rows up to the one with the limit-th success can matter
    stop = judged.where("issue = ''").orderBy("position").limit(limit).agg(F.max("position").alias("last"), F.count("*").alias("n"))
    head = judged.join(F.broadcast(stop)).where((F.col("n") < limit) | (F.col("position") <= F.col("last")))
    return head.select("position", F.when(F.col("issue") == "", F.concat(F.lit("scenario_"), F.substring(F.sha2("source_instance_id", 256), 1, 16))).alias("scenario_id"), "issue")


def quarantined(imports: DataFrame, synthetic: DataFrame, holdouts: DataFrame, filters: DataFrame) -> DataFrame:
    """One row: records set aside by four kinds of summaries and the number of their issues.

    The first three have skipped and issues, the last quarantined and issues; null counts as none.
    """
    sides = [d.select(F.col("skipped").alias("n"), "issues") for d in (imports, synthetic, holdouts)] + [filters.select(F.col("quarantined").alias("n"), "issues")]
    every = sides[0]
    for side in sides[1:]:
        every = every.unionByName(side)
    found = F.greatest(F.coalesce(F.size("issues"), F.lit(0)), F.lit(0))
    return every.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("records"), F.coalesce(F.sum(found), F.lit(0)).cast("long").alias("issues"))


def failure_evidence(results: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Per source instance the last failed result: source_instance_id, scenario_id, summary.

    results: summary (order), position, scenario_id, source_instance_id, valid; scenarios: scenario_id,
    source_instance_id. A result without an instance takes its scenario's; without either it is left out.
    """
    known = scenarios.select("scenario_id", F.col("source_instance_id").alias("_own")).where("_own <> ''").dropDuplicates(["scenario_id"])
    failed = results.where(~F.coalesce("valid", F.lit(True))).join(known, "scenario_id", "left")
    instance = F.coalesce(F.nullif(F.trim("source_instance_id"), F.lit("")), F.col("_own"))
    last = failed.withColumn("_id", instance).where("_id is not null").groupBy("_id").agg(F.max(F.struct("summary", "position", "scenario_id")).alias("last"))
    return last.select(F.col("_id").alias("source_instance_id"), "last.scenario_id", "last.summary")


def selected_ids(rows: DataFrame, key: str, explicit: DataFrame | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Rows whose id is asked for: explicit and listed ids together mean those in both, neither means all rows.

    An empty table of ids that is given does ask, for nothing.
    """
    asked = explicit if listed is None else listed if explicit is None else explicit.select(key).intersect(listed.select(key))
    return rows if asked is None else rows.join(asked.select(key).distinct(), key, "left_semi")


def job_selection(explicit: DataFrame, listed: DataFrame) -> DataFrame | None:
    """Distinct ids of both tables; None if there are none, which means that nothing is left out."""
    both = explicit.select("job_id").unionByName(listed.select("job_id")).where("job_id is not null").distinct()
    return None if both.isEmpty() else both
