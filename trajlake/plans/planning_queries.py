"""Queries over collection plans: preflight, readiness, remediation of slots and missing evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.operators import planning as P
from trajlake.plans import adapters as A
from trajlake.plans.registry import query
from trajlake.plans.strict_queries import _label, _sql

TASKS = "SELECT s_suppkey AS position, CASE CAST(s_suppkey % 6 AS INTEGER) WHEN 0 THEN 'Pull-Requests' WHEN 1 THEN 'issues' WHEN 2 THEN ' CI ' WHEN 3 THEN 'wiki' WHEN 4 THEN NULL ELSE 'issues' END AS collection_source, ' ' || s_name AS repository FROM supplier"
PLAN = "SELECT count(*) < 0 AS valid, CAST(0 AS BIGINT) AS total_tasks FROM supplier"
FILES = "SELECT n_name AS path, CASE WHEN n_nationkey % 3 = 0 THEN 'source' ELSE 'summary' END AS role, n_nationkey % 4 <> 1 AS present, n_nationkey % 5 <> 2 AS readable FROM nation"
_page = f"t AS (SELECT *, row_number() OVER (ORDER BY position) - 1 AS i FROM ({TASKS})), pg AS (SELECT *, lower(replace(trim(coalesce(collection_source, '')), '-', '_')) AS k FROM t WHERE i >= 10 AND i < 60)"


@query(
    f"""WITH {_page} SELECT 'source_collection_plan_invalid' AS code, CAST(NULL AS BIGINT) AS task_index, CAST(NULL AS VARCHAR) AS repository, CAST(NULL AS VARCHAR) AS file UNION ALL SELECT 'missing_token', NULL, NULL, NULL UNION ALL SELECT 'no_selected_collection_tasks', NULL, NULL, NULL WHERE NOT EXISTS (SELECT * FROM pg)
 UNION ALL SELECT 'unsupported_collection_task', i, trim(repository), NULL FROM pg WHERE k NOT IN ('issues', 'pull_requests', 'ci') UNION ALL SELECT * FROM (SELECT CASE WHEN role = 'source' AND NOT present THEN 'missing_source_records' WHEN role = 'source' AND NOT readable THEN 'source_records_invalid'
 WHEN role = 'summary' AND NOT present THEN 'missing_collection_summary' WHEN role = 'summary' AND NOT readable THEN 'collection_summary_invalid' END AS c, NULL, NULL, path FROM ({FILES})) WHERE c IS NOT NULL"""
)
def preflight_issues(spark, sf):
    plan, tasks, files = (_sql(spark, sf, ["supplier", "nation"], t) for t in (PLAN, TASKS, FILES))
    return P.preflight_issues(plan, tasks, files, offset=10, most=50, token_required=True, source_required=True)


@query(f"WITH {_page} SELECT count(*) AS selected_tasks, count(*) FILTER (k IN ('issues', 'pull_requests', 'ci')) AS supported_tasks, CAST(1 + CASE WHEN count(*) = 0 THEN 1 ELSE 0 END + count(*) FILTER (k NOT IN ('issues', 'pull_requests', 'ci')) AS BIGINT) AS issues, false AS ready FROM pg")
def preflight_summary(spark, sf):
    plan, tasks, files = (_sql(spark, sf, ["supplier", "nation"], t) for t in (PLAN, TASKS, FILES))
    return P.preflight_summary(tasks, P.preflight_issues(plan, tasks, files.limit(0), offset=10, most=50), offset=10, most=50)


EXPORT = "SELECT count(*) < 0 AS valid, count(*) + 1 AS plan_tasks, count(*) - 5 AS selected_tasks, CAST(3 AS BIGINT) AS skipped_tasks, CAST(sum(s_nationkey) AS BIGINT) AS exported, CAST(2 AS BIGINT) AS issues FROM supplier"
AUDIT = "SELECT count(*) < 0 AS valid, count(*) AS total, CAST(sum(CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS accepted, CAST(sum(CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS quarantined FROM pages"


@query(
    f"""WITH e AS ({EXPORT}), a AS ({AUDIT}), n AS (SELECT count(*) AS n FROM supplier) SELECT 'source_collection_plan_invalid' AS code, 'error' AS severity, '' AS detail UNION ALL SELECT 'source_export_summary_invalid', 'error', '' UNION ALL SELECT 'source_collection_audit_failed', 'error', ''
 UNION ALL SELECT 'accepted_records_below_minimum', 'error', accepted || ' against 1000000' FROM a WHERE accepted < 1000000 UNION ALL SELECT 'quarantine_budget_exceeded', 'error', quarantined || ' against 7' FROM a WHERE quarantined > 7
 UNION ALL SELECT 'audit_export_count_mismatch', 'error', total || ' against ' || exported FROM a, e WHERE total <> exported UNION ALL SELECT 'plan_export_task_count_mismatch', 'error', n || ' against ' || plan_tasks FROM e, n WHERE n <> plan_tasks
 UNION ALL SELECT 'partial_plan_selection', 'error', selected_tasks || ' against ' || n FROM e, n WHERE selected_tasks < n UNION ALL SELECT 'missing_required_source_type', 'error', t FROM (SELECT unnest(['ci_run', 'discussion', 'issue']) AS t) WHERE t NOT IN (SELECT CASE CAST(page_id % 4 AS INTEGER) WHEN 0 THEN 'issue' WHEN 1 THEN 'pull_request' WHEN 2 THEN 'ci_run' ELSE '' END FROM pages WHERE page_id % 3 = 0)
 UNION ALL SELECT 'source_export_issues', 'error', '2' UNION ALL SELECT 'skipped_collection_tasks', 'warning', '3'"""
)
def collection_readiness(spark, sf):
    plan, tasks, export, audit = (_sql(spark, sf, ["supplier", "pages"], t) for t in (PLAN, TASKS, EXPORT, AUDIT))
    accepted = A.records(spark, sf).where("position % 3 = 0").select("source_type")
    return P.readiness(plan, tasks, export, audit, accepted, least_accepted=1_000_000, most_quarantined=7, clean_export=True, all_tasks=True, source_types=("issue", "ci_run", "discussion"))


SLOTS = """SELECT p_partkey AS slot_id, CASE CAST(p_partkey % 7 AS INTEGER) WHEN 0 THEN 'share_cap_diversity' WHEN 1 THEN 'share_cap_diversity' WHEN 2 THEN 'share_cap_diversity' WHEN 3 THEN 'source_method_minimum' WHEN 4 THEN 'verifier_type_minimum' WHEN 5 THEN 'verifier_type_minimum' ELSE NULL END AS type,
 CASE CAST(p_partkey % 7 AS INTEGER) WHEN 3 THEN CASE WHEN p_size > 10 THEN 'public_issue_workspace' ELSE 'other' END WHEN 4 THEN 'build_command' WHEN 5 THEN 'hidden_test_patch' ELSE 'x' END AS target, CASE CAST(p_partkey % 7 AS INTEGER) WHEN 0 THEN 'language' WHEN 1 THEN 'repository' ELSE 'source' END AS dimension,
 'org/' || CAST(p_size % 30 AS {s}) AS dominant_label, p_size AS minimum_count FROM part"""
ALLOWED = "SELECT CASE WHEN n_nationkey % 9 = 8 THEN ' ' ELSE 'org/' || CAST(n_nationkey AS {s}) END AS repository, CASE CAST(n_nationkey % 4 AS INTEGER) WHEN 0 THEN 'Python ' WHEN 1 THEN 'go' WHEN 2 THEN NULL ELSE 'Rust' END AS language FROM nation"
PLANNED = f"""p AS (SELECT slot_id, coalesce(type, '') AS type, target, dominant_label, minimum_count, CASE WHEN type = 'share_cap_diversity' THEN CASE dimension WHEN 'language' THEN 'collect_cross_language_sources' WHEN 'repository' THEN 'collect_non_dominant_repository_sources' ELSE 'collect_share_cap_diversity_sources' END
 WHEN type = 'source_method_minimum' AND target = 'public_issue_workspace' THEN 'collect_public_issue_sources' WHEN target = 'build_command' THEN 'collect_build_command_evidence' WHEN target = 'hidden_test_patch' THEN 'curate_hidden_test_patch_evidence' ELSE 'satisfy_reserved_backfill_slot' END AS action FROM ({SLOTS.format(s='VARCHAR')})),
 w AS (SELECT DISTINCT trim(repository) AS repository, {_label("coalesce(language, '')")} AS language FROM ({ALLOWED.format(s='VARCHAR')}) WHERE trim(repository) <> '')"""


def _planned(spark, sf):
    return P.remediation(_sql(spark, sf, ["part"], SLOTS.format(s="STRING"))), _sql(spark, sf, ["nation"], ALLOWED.format(s="STRING"))


@query(f"WITH {PLANNED} SELECT * FROM p")
def remediation_plan(spark, sf):
    return _planned(spark, sf)[0]


@query(
    f"""WITH {PLANNED} SELECT 'collect_cross_language_sources' AS action, repository, (SELECT count(*) FROM p WHERE action = 'collect_cross_language_sources') AS slots FROM w WHERE language NOT IN ('', 'python')
 UNION ALL SELECT action, repository, count(*) FROM p JOIN w ON repository <> dominant_label WHERE action = 'collect_non_dominant_repository_sources' GROUP BY 1, 2"""
)
def remediation_candidates(spark, sf):
    return P.remediation_candidates(*_planned(spark, sf))


@query("SELECT 'missing_cross_language_allowlist_candidate' AS code, 'error' AS severity WHERE EXISTS (SELECT * FROM part) AND EXISTS (SELECT * FROM nation WHERE n_nationkey = 0) UNION ALL SELECT 'missing_non_dominant_repository_candidate', 'error' WHERE EXISTS (SELECT * FROM part WHERE p_partkey % 7 = 1 AND p_size % 30 = 0)")
def remediation_issues(spark, sf):
    planned, allowed = _planned(spark, sf)
    return P.remediation_issues(planned, allowed.where("repository = 'org/0'"))


def _specs(spark, sf):
    n = F.col("p_partkey")

    def commands(when):
        return F.when(when, F.array(F.lit("run"))).otherwise(F.array(F.lit(" ")))

    def target(k: int):
        return F.struct(
            F.lit(f"t{k}").alias("name"), commands((n % 5 == 0) & (k == 1)).alias("doctest_commands"), F.array().cast("array<string>").alias("example_commands"), commands((n % 7 == 0) & (k == 2)).alias("benchmark_commands"),
            F.when((n % 11 == 0) & (k == 2), F.create_map(F.lit("max_ms"), F.lit(50.0))).alias("performance_threshold"),
        )

    families = F.when(n % 3 == 0, F.array(F.lit("docs_examples"))).when(n % 3 == 1, F.array(F.lit("Performance"), F.lit("docs-examples"))).otherwise(F.array().cast("array<string>"))
    nothing = F.lit(None).cast("map<string,double>")
    return A.table(spark, sf, "part").select(
        n.alias("spec_id"), F.col("p_brand").alias("repository"), F.concat(F.lit("r"), n.cast("string")).alias("source_revision"), families.alias("task_families"), F.when(n % 4 != 0, F.array(target(1), target(2))).alias("targets"),
        commands(F.lit(False)).alias("doctest_commands"), commands(n % 13 == 0).alias("example_commands"), commands(F.lit(False)).alias("benchmark_commands"), nothing.alias("performance_threshold"),
    )


EVIDENCE = """v_missing AS (SELECT 'evidence_' || substr(sha256(p_brand || '|r' || CAST(p_partkey AS VARCHAR) || '|' || f || '|' || t), 1, 16) AS evidence_task_id, p_partkey AS spec_id, p_brand AS repository, f AS task_family, t AS target_name,
 CASE f WHEN 'docs_examples' THEN 'doctest_or_example_command' ELSE 'benchmark_command_or_performance_threshold' END AS missing FROM part JOIN (VALUES (0, 'docs_examples'), (1, 'performance'), (1, 'docs_examples')) fam(m, f) ON p_partkey % 3 = m JOIN (VALUES (''), ('t1'), ('t2')) tar(t) ON (p_partkey % 4 = 0) = (t = '')
 WHERE CASE f WHEN 'docs_examples' THEN NOT (p_partkey % 13 = 0 OR (t = 't1' AND p_partkey % 5 = 0)) ELSE NOT (t = 't2' AND (p_partkey % 7 = 0 OR p_partkey % 11 = 0)) END)"""


@query(f"WITH {EVIDENCE} SELECT * FROM v_missing")
def missing_evidence(spark, sf):
    return P.missing_evidence(_specs(spark, sf))


@query(f"WITH {EVIDENCE} SELECT 'task_family' AS dimension, task_family AS label, count(*) AS tasks FROM v_missing GROUP BY 2 UNION ALL SELECT 'missing', missing, count(*) FROM v_missing GROUP BY 2")
def evidence_counts(spark, sf):
    return P.evidence_counts(P.missing_evidence(_specs(spark, sf)))


@query(
    f"""WITH {EVIDENCE}, n AS (SELECT *, row_number() OVER (ORDER BY evidence_task_id) - 1 AS i FROM v_missing) SELECT 'shard_' || lpad(CAST(i // 40 AS VARCHAR), 6, '0') AS shard_id, evidence_task_id, repository, task_family, target_name,
 CASE task_family WHEN 'docs_examples' THEN 'doctest_commands,example_commands' ELSE 'benchmark_commands,performance_threshold' END AS fields, 'template' AS outcome FROM n UNION ALL SELECT 'odd', 'evidence_none', NULL, NULL, NULL, NULL, 'absent'"""
)
def evidence_templates(spark, sf):
    missing = P.missing_evidence(_specs(spark, sf))
    odd = A.table(spark, sf, "region").where("r_regionkey = 0").select(F.lit("odd").alias("shard_id"), F.array(F.lit("evidence_none"), F.lit("")).alias("evidence_task_ids"))
    return P.evidence_templates(missing, P.first_of_shards(missing, 40).unionByName(odd))


SHARDS = "SELECT c_custkey AS shard_id, CAST(5 AS BIGINT) AS selected_tasks FROM customer"
_state = "CASE CAST(c_custkey % {m} AS INTEGER) WHEN 0 THEN 'missing' WHEN 1 THEN 'invalid' ELSE 'present' END"
ARTIFACTS = " UNION ALL ".join(
    f"SELECT c_custkey AS shard_id, '{k}' AS kind, {_state.format(m=m)} AS state, {'c_custkey % 4 <> 1' if k == 'apply' else 'CAST(NULL AS BOOLEAN)'} AS valid, {'CAST(c_custkey % 2 AS BIGINT)' if k == 'apply' else 'CAST(NULL AS BIGINT)'} AS remaining, {'CAST(c_custkey % 3 AS BIGINT)' if k == 'spec' else 'CAST(NULL AS BIGINT)'} AS repositories FROM customer WHERE c_custkey % {w} <> 0"
    for k, m, w in (("template", 5, 13), ("records", 7, 17), ("apply", 9, 19), ("spec", 6, 23))
)
SELECTED = "SELECT c_custkey AS shard_id, 'e' || CAST(k AS {s}) AS evidence_task_id FROM customer JOIN (VALUES (1), (2), (3)) t(k) ON c_custkey % 10 <> 0"
GIVEN = "SELECT c_custkey AS shard_id, CASE WHEN k = 5 THEN '' ELSE 'e' || CAST(k AS {s}) END AS evidence_task_id FROM customer JOIN (VALUES (2), (3), (3), (4), (5)) t(k) ON k > c_custkey % 4"
APPLIED = "SELECT c_custkey AS shard_id, 'e' || CAST(k AS {s}) AS evidence_task_id FROM customer JOIN (VALUES (1), (2), (3), (9)) t(k) ON c_custkey % 3 <> 0 OR k <> 2"


@query(
    f"""WITH f AS (SELECT c_custkey AS shard_id, {", ".join(f"CASE WHEN c_custkey % {w} = 0 THEN 'missing' ELSE {_state.format(m=m)} END AS {k}" for k, m, w in (("template", 5, 13), ("file", 7, 17), ("apply", 9, 19), ("spec", 6, 23)))}, c_custkey % 4 <> 1 AND c_custkey % 19 <> 0 AS valid, CASE WHEN c_custkey % 19 = 0 THEN 0 ELSE c_custkey % 2 END AS said, CASE WHEN c_custkey % 23 = 0 THEN 0 ELSE c_custkey % 3 END AS repositories FROM customer),
 t AS ({SELECTED.format(s='VARCHAR')}), r AS ({GIVEN.format(s='VARCHAR')}), a AS ({APPLIED.format(s='VARCHAR')}),
 c AS (SELECT *, (SELECT count(*) FROM r WHERE r.shard_id = f.shard_id) AS n, (SELECT count(*) FROM t WHERE t.shard_id = f.shard_id) AS k, (SELECT count(*) FROM t WHERE t.shard_id = f.shard_id AND evidence_task_id IN (SELECT evidence_task_id FROM r WHERE r.shard_id = f.shard_id)) AS m,
  (SELECT count(DISTINCT evidence_task_id) FROM r WHERE r.shard_id = f.shard_id AND evidence_task_id <> '' AND evidence_task_id NOT IN (SELECT evidence_task_id FROM t WHERE t.shard_id = f.shard_id)) AS x, (SELECT count(*) FROM t WHERE t.shard_id = f.shard_id AND evidence_task_id NOT IN (SELECT evidence_task_id FROM a WHERE a.shard_id = f.shard_id)) AS l FROM f),
 o AS (SELECT *, CASE WHEN k > 0 THEN l ELSE said END AS over FROM c),
 s AS (SELECT *, CASE WHEN file = 'missing' THEN CASE template WHEN 'invalid' THEN 'blocked:fix_evidence_template' WHEN 'present' THEN 'pending:fill_evidence_template' ELSE 'pending:collect_evidence' END WHEN file = 'invalid' THEN 'blocked:fix_evidence_records' WHEN apply = 'missing' THEN 'ready_to_apply:apply_evidence' WHEN apply = 'invalid' THEN 'blocked:inspect_apply_output'
  WHEN NOT valid THEN 'blocked:resolve_apply_errors' WHEN over > 0 THEN 'partial:collect_remaining_evidence' WHEN spec = 'missing' THEN 'ready_to_finalize:write_spec_output' WHEN spec = 'invalid' OR repositories = 0 THEN 'blocked:fix_spec_output' ELSE 'complete:none' END AS state FROM o)
 SELECT shard_id, split_part(state, ':', 1) AS status, split_part(state, ':', 2) AS next_action, CASE WHEN file = 'present' THEN n ELSE 0 END AS records, CASE WHEN file = 'present' THEN m ELSE 0 END AS matching, CASE WHEN file = 'present' THEN x ELSE 0 END AS extra, CASE WHEN file = 'present' THEN k - m ELSE k END AS absent,
 CAST(CASE WHEN file <> 'present' OR apply = 'missing' THEN 5 WHEN apply = 'invalid' THEN 0 ELSE over END AS BIGINT) AS remaining FROM s"""
)
def evidence_shard_states(spark, sf):
    return P.evidence_shard_states(*[_sql(spark, sf, ["customer"], t.format(s="STRING")) for t in (SHARDS, ARTIFACTS, SELECTED, GIVEN, APPLIED)])
