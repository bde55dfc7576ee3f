"""Queries over source records, collection plans and curation."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions.text import source_uri
from trajlake.operators import corpus, records as R
from trajlake.plans import adapters as A
from trajlake.plans.registry import query

W = f"WITH {A.RECORDS}, {A.ALLOW} "
OK = "(" + ", ".join(f"'{v}'" for v in R.LICENSES) + ")"
KIND = "CASE source_type WHEN 'pull_request' THEN 'public_pull_request' WHEN 'ci_run' THEN 'public_ci' ELSE 'public_issue' END"
ISSUES = f"""v_issues AS (SELECT position, unnest(list_filter([CASE WHEN source_instance_id = '' THEN 'missing_instance_id' END, CASE WHEN title = '' THEN 'missing_title' END,
 CASE WHEN NOT regexp_full_match(revision, '[0-9a-f]{{40}}') THEN 'revision_not_fixed' END, CASE WHEN license = '' THEN 'missing_license' WHEN replace(replace(lower(trim(license)), '-', '_'), ' ', '_') NOT IN {OK} THEN 'license_not_allowed' END,
 CASE WHEN source_url NOT LIKE 'https://%' THEN 'url_not_https' END, CASE WHEN source_type = '' THEN 'missing_source_type' END], lambda x: x IS NOT NULL)) AS code FROM v_records)"""
LAST = "v_last AS (SELECT repository, arg_max(license, position) AS allow_license FROM v_allow GROUP BY repository)"
REASON = f"""v_reason AS (SELECT position, CASE WHEN allow_license IS NULL THEN 'repository_not_allowlisted' WHEN replace(replace(lower(allow_license), '-', '_'), ' ', '_') NOT IN {OK} THEN 'repository_license' WHEN replace(replace(lower(trim(license)), '-', '_'), ' ', '_') NOT IN {OK} THEN 'record_license' ELSE '' END AS reason
 FROM v_records LEFT JOIN v_last USING (repository))"""
ACCEPTED = """v_accepted AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_instance_id ORDER BY position) AS n FROM v_records) WHERE n = 1 AND position IN (SELECT position FROM v_reason WHERE reason = '') AND position NOT IN (SELECT position FROM v_issues))"""
ALL = f"{W}, {ISSUES}, {LAST}, {REASON}, {ACCEPTED} "


def _records(spark, sf):
    return A.records(spark, sf)


@query(W + f"SELECT position, {KIND} AS source_type FROM v_records")
def source_type_classify(spark, sf):
    return _records(spark, sf).select("position", R.source_type(F.col("source_type")).alias("source_type"))


@query(ALL + "SELECT code, count(*) AS records FROM v_issues GROUP BY code UNION ALL SELECT 'approved', count(*) FROM v_records WHERE position NOT IN (SELECT position FROM v_issues)")
def allowlist_audit(spark, sf):
    r = _records(spark, sf)
    found = R.issues(r)
    approved = r.select("position").join(found.select("position").distinct(), "position", "left_anti").agg(F.count("*").alias("records")).select(F.lit("approved").alias("code"), "records")
    return found.groupBy("code").agg(F.count("*").alias("records")).unionByName(approved)


@query(ALL + "SELECT * FROM v_reason")
def allowlist_filter(spark, sf):
    return R.allowlist_filter(_records(spark, sf), A.allowlist(spark, sf))


@query(ALL + f"SELECT {KIND} AS source_type, count(*) AS records, count(a.p) AS accepted, count(DISTINCT repository) AS repositories FROM v_records LEFT JOIN (SELECT position AS p FROM v_accepted) a ON p = position GROUP BY 1")
def source_audit(spark, sf):
    return R.audit(_records(spark, sf), A.allowlist(spark, sf))


@query(ALL + "SELECT position, source_instance_id, repository FROM v_accepted")
def corpus_build(spark, sf):
    return R.accepted(_records(spark, sf), A.allowlist(spark, sf)).select("position", "source_instance_id", "repository")


TOK = "regexp_extract_all(lower(title), '[a-z0-9]+')"


def _has(*names):
    return f"len(list_intersect({TOK}, [{', '.join(repr(n) for n in names)}])) > 0"


@query(W + f"""SELECT position, CASE WHEN {_has('slow', 'performance', 'benchmark')} AND has_verifier THEN 'performance' WHEN {_has('docs', 'typo')} THEN 'docs_examples' WHEN {_has('refactor', 'cleanup')} THEN 'refactor'
 WHEN {_has('add', 'feature')} THEN 'feature' WHEN source_type = 'pull_request' THEN 'code_review' ELSE 'bug_repair' END AS task_family FROM v_records""")
def infer_task_family(spark, sf):
    return R.task_family(_records(spark, sf))


@query("SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(url, '[?#].*$', '')), '^([a-z]+://)(?:[^/@]*@)?([^/:]*)(?::[0-9]+)?', '\\1\\2'), '/+$', ''), '\\.git$', '') AS uri FROM pages")
def source_uri_normalize(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", source_uri(F.col("url")).alias("uri"))


SHAPE = "'^https?://([^/?#]+)/([a-z]{2})/([0-9]+)(?:[/.?#].*)?$'"


@query(f"SELECT page_id, CASE WHEN regexp_matches(url, {SHAPE}) THEN concat_ws('#', regexp_extract(url, {SHAPE}, 1), regexp_extract(url, {SHAPE}, 2), regexp_extract(url, {SHAPE}, 3)) END AS identity FROM pages")
def source_identity(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", R.identity(F.col("url")).alias("identity"))


@query(W + f"SELECT position, source_instance_id FROM v_records WHERE {KIND} IN ('public_issue', 'public_ci') AND {KIND} NOT IN ('public_pull_request')")
def source_split_by_type(spark, sf):
    return R.split_by_type(_records(spark, sf), ["public_issue", "public_ci"], ["public_pull_request"]).select("position", "source_instance_id")


@query(W + "SELECT position, coalesce(nullif(trim(source_instance_id), ''), repository || '__' || language || '-' || CAST(position AS VARCHAR)) AS instance_id FROM v_records")
def source_instance_ids(spark, sf):
    return _records(spark, sf).select("position", F.coalesce(F.nullif(F.trim("source_instance_id"), F.lit("")), F.concat("repository", F.lit("__"), "language", F.lit("-"), F.col("position").cast("string"))).alias("instance_id"))


@query(W + """SELECT repository, revision, count(*) AS records, count(DISTINCT source_type) AS types, array_to_string(list_slice(list_sort(list_distinct(list(source_instance_id))), 1, 5), ',') AS first_ids FROM v_records WHERE source_instance_id <> '' GROUP BY 1, 2""")
def workspace_tasks(spark, sf):
    return R.workspaces(_records(spark, sf))


@query("SELECT 'task_' || substr(sha256(n_name || ':' || s), 1, 16) AS task_id, n_name AS repository, s AS source FROM nation, (SELECT unnest(['issues', 'pull_requests', 'ci_runs']) AS s)")
def collection_tasks(spark, sf):
    n = A.table(spark, sf, "nation").select(F.col("n_name").alias("repository"), F.explode(F.array(*[F.lit(s) for s in ("issues", "pull_requests", "ci_runs")])).alias("source"))
    return n.select(F.concat(F.lit("task_"), F.substring(F.sha2(F.concat("repository", F.lit(":"), "source"), 256), 1, 16)).alias("task_id"), "repository", "source")


@query(W + """, e AS (SELECT source_instance_id, min(position) AS position FROM v_records WHERE position < 100 AND source_instance_id <> '' GROUP BY 1), n AS (SELECT source_instance_id, min(position) AS position FROM v_records WHERE position >= 100 GROUP BY 1)
 SELECT * FROM e UNION ALL SELECT * FROM n WHERE source_instance_id NOT IN (SELECT source_instance_id FROM e)""")
def incremental_append(spark, sf):
    r = _records(spark, sf).select("source_instance_id", "position")
    old = r.where("position < 100 and source_instance_id <> ''").groupBy("source_instance_id").agg(F.min("position").alias("position"))
    return R.append_new(old, r.where("position >= 100"), "source_instance_id", "position")


@query("""SELECT task_id, reason FROM (SELECT CAST(s_suppkey AS VARCHAR) AS task_id, CASE WHEN s_nationkey % 4 = 0 THEN 'failed' WHEN s_nationkey % 4 = 1 AND s_suppkey % 5 <> 0 THEN 'missing_outcome' WHEN s_suppkey % 5 = 0 THEN 'not_selected' END AS reason FROM supplier) WHERE reason IS NOT NULL""")
def retry_plan(spark, sf):
    s = A.table(spark, sf, "supplier")
    tasks = s.select(F.col("s_suppkey").cast("string").alias("task_id"), (F.col("s_suppkey") % 5 != 0).alias("selected"))
    outcomes = s.where("s_nationkey % 4 <> 1").select(F.col("s_suppkey").cast("string").alias("task_id"), F.when(F.col("s_nationkey") % 4 == 0, "failed").otherwise("done").alias("status"))
    return R.retry_tasks(tasks, outcomes)


@query("""SELECT status, count(*) AS tasks, CAST(sum(n) AS BIGINT) AS new_records FROM (SELECT l_partkey, CASE arg_max(l_returnflag, l_orderkey * 10 + l_linenumber) WHEN 'R' THEN 'failed' ELSE 'done' END AS status, arg_max(CAST(l_quantity AS BIGINT), l_orderkey * 10 + l_linenumber) AS n
 FROM (SELECT l_partkey, l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1) GROUP BY 1""")
def merge_shard_summaries(spark, sf):
    li = A.table(spark, sf, "lineitem").groupBy("l_partkey", "l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("f"), F.max("l_quantity").alias("q"))
    return R.merged_outcomes(li.select(F.col("l_partkey").alias("task_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("shard"), F.when(F.col("f") == "R", "failed").otherwise("done").alias("status"), F.col("q").cast("long").alias("new_records")))


@query("""SELECT shard_id, state, CASE state WHEN 'complete' THEN 'none' WHEN 'partial' THEN 'retry' WHEN 'blocked' THEN 'fix_preflight' WHEN 'invalid' THEN 'fix_preflight' ELSE 'run_export' END AS next_action FROM (SELECT c_custkey AS shard_id,
 CASE WHEN c_nationkey % 5 = 0 THEN 'invalid' WHEN c_mktsegment = 'BUILDING' THEN 'complete' WHEN c_mktsegment = 'MACHINERY' THEN 'partial' WHEN c_nationkey % 5 = 1 THEN 'blocked' ELSE 'pending' END AS state FROM customer)""")
def shard_next_action(spark, sf):
    c = A.table(spark, sf, "customer")
    return R.next_action(c.select(F.col("c_custkey").alias("shard_id"), F.when(F.col("c_nationkey") % 5 == 0, "invalid").when(F.col("c_nationkey") % 5 == 1, "blocked").otherwise("ready").alias("preflight"), F.when(F.col("c_mktsegment") == "BUILDING", "complete").when(F.col("c_mktsegment") == "MACHINERY", "partial").alias("export")))


@query("""SELECT seed_id, CASE WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'duplicated' ELSE 'copied' END AS outcome FROM (SELECT p_partkey AS seed_id, count(l_orderkey) AS n FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber = 7) ON l_partkey = p_partkey GROUP BY 1)""")
def candidate_assembly(spark, sf):
    return R.assembly(A.table(spark, sf, "part").select(F.col("p_partkey").alias("seed_id")), A.table(spark, sf, "lineitem").where("l_linenumber = 7").select(F.col("l_partkey").alias("seed_id")))


@query("""SELECT task_id, position, CASE WHEN task_id % 3 = 0 THEN 'unused' WHEN n > 1 THEN 'duplicate' WHEN NOT complete THEN 'incomplete' ELSE 'applied' END AS outcome FROM (SELECT o_custkey AS task_id, o_orderkey AS position, o_orderstatus <> 'P' AS complete, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders)""")
def evidence_apply(spark, sf):
    o = A.table(spark, sf, "orders").select(F.col("o_custkey").alias("task_id"), F.col("o_orderkey").alias("position"), (F.col("o_orderstatus") != "P").alias("complete"))
    return R.evidence(A.table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("task_id")), o)


@query("""WITH l AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS owner FROM orders WHERE o_orderkey % 10 <> 3), r AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 1 THEN 'X' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 75 = 1 THEN -1 ELSE o_custkey END AS owner FROM orders WHERE o_orderkey % 10 <> 4)
 SELECT * FROM (SELECT coalesce(l.id, r.id) AS id, CASE WHEN r.id IS NULL THEN 'missing' WHEN l.id IS NULL THEN 'unexpected' ELSE array_to_string(list_filter([CASE WHEN l.status <> r.status THEN 'status' END, CASE WHEN l.owner <> r.owner THEN 'owner' END], lambda x: x IS NOT NULL), ',') END AS difference FROM l FULL OUTER JOIN r ON l.id = r.id) WHERE difference <> ''""")
def queue_contract_diff(spark, sf):
    o = A.table(spark, sf, "orders")
    left = o.where("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("owner"))
    right = o.where("o_orderkey % 10 <> 4").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 50 == 1, "X").otherwise(F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 75 == 1, -1).otherwise(F.col("o_custkey")).alias("owner"))
    return R.reconcile(left, right, "id", ["status", "owner"])


@query("""SELECT coalesce(d, l) AS doc_id, CASE WHEN l IS NULL THEN 'missing' ELSE 'unexpected' END AS difference FROM (SELECT doc_id AS d FROM documents WHERE doc_id % 4 <> 0) FULL OUTER JOIN (SELECT doc_id AS l FROM labels) ON d = l WHERE d IS NULL OR l IS NULL""")
def id_set_reconciliation(spark, sf):
    return R.reconcile(A.table(spark, sf, "documents").where("doc_id % 4 <> 0").select("doc_id"), A.table(spark, sf, "labels").select("doc_id"), "doc_id", [])


@query("""WITH f AS (SELECT 'q' || CAST(quality AS VARCHAR) AS code, CAST(doc_id AS VARCHAR) AS entry, CASE WHEN toxic = 1 THEN 'error' ELSE 'warning' END AS severity FROM labels), w AS (SELECT 'q0' AS code, CAST(doc_id AS VARCHAR) AS entry FROM documents WHERE doc_id % 3 = 0)
 SELECT coalesce(f.code, w.code) AS code, coalesce(f.entry, w.entry) AS entry, CASE WHEN severity IS NULL THEN 'unmatched_waiver' WHEN w.code IS NULL THEN 'open' WHEN severity = 'warning' THEN 'waived' ELSE 'not_waivable' END AS outcome FROM f FULL OUTER JOIN w ON f.code = w.code AND f.entry = w.entry""")
def waiver_resolution(spark, sf):
    f = A.table(spark, sf, "labels").select(F.concat(F.lit("q"), F.col("quality").cast("string")).alias("code"), F.col("doc_id").cast("string").alias("entry"), F.when(F.col("toxic") == 1, "error").otherwise("warning").alias("severity"))
    return R.waivers(f, A.table(spark, sf, "documents").where("doc_id % 3 = 0").select(F.lit("q0").alias("code"), F.col("doc_id").cast("string").alias("entry")))


@query("""SELECT slot, n_name AS repository FROM (SELECT unnest(range(0, 60)) AS slot) JOIN (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS r, count(*) OVER () AS n FROM nation) ON slot % n = r""")
def synthetic_round_robin(spark, sf):
    return R.round_robin_slots(60, A.table(spark, sf, "nation").select(F.col("n_name").alias("repository")), "repository")


@query("""SELECT n_name AS repository, r_name AS target, f AS family, 'Improve ' || lower(r_name) || ' in ' || n_name AS query FROM nation JOIN region ON n_regionkey = r_regionkey, (SELECT unnest(['bug_repair', 'docs_examples', 'performance']) AS f) WHERE NOT (f = 'performance' AND n_nationkey % 2 = 1)""")
def synthetic_cross_product(spark, sf):
    n = A.table(spark, sf, "nation").join(F.broadcast(A.table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    crossed = n.withColumn("family", F.explode(F.array(*[F.lit(f) for f in ("bug_repair", "docs_examples", "performance")]))).where("not (family = 'performance' and n_nationkey % 2 = 1)")
    return crossed.select(F.col("n_name").alias("repository"), F.col("r_name").alias("target"), "family", F.concat(F.lit("Improve "), F.lower("r_name"), F.lit(" in "), "n_name").alias("query"))


@query("""SELECT p_partkey AS spec, p_brand || '|' || p_type AS target_key, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) > 1 AS duplicate FROM part""")
def spec_combine_duplicates(spark, sf):
    from pyspark.sql import Window

    p = A.table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("spec"), F.concat("p_brand", F.lit("|"), "p_type").alias("target_key"), (F.row_number().over(Window.partitionBy("p_brand", "p_type").orderBy("p_partkey")) > 1).alias("duplicate"))


@query("""SELECT 'c_' || CAST(c_custkey AS VARCHAR) AS scenario_id, i AS rollout_index, 'job_' || substr(sha256(concat_ws(':', 'c_' || CAST(c_custkey AS VARCHAR), CAST(i AS VARCHAR), 'model', 'contract')), 1, 20) AS job_id FROM customer, (SELECT unnest([0, 1]) AS i)""")
def rollout_assignments(spark, sf):
    c = A.table(spark, sf, "customer").select(F.concat(F.lit("c_"), F.col("c_custkey").cast("string")).alias("scenario_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("rollout_index"))
    return c.withColumn("job_id", F.concat(F.lit("job_"), F.substring(F.sha2(F.concat_ws(":", "scenario_id", F.col("rollout_index").cast("string"), F.lit("model"), F.lit("contract")), 256), 1, 20)))


@query(W + """, c AS (SELECT * FROM v_records WHERE source_type <> 'ci_run' AND source_instance_id <> '' AND title <> '' AND regexp_full_match(revision, '[0-9a-f]{40}') AND lower(title) NOT LIKE '%benchmark%' AND has_verifier)
 SELECT position, repository, CAST(turn AS INTEGER) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY language, repository, source_type ORDER BY position) AS turn FROM c) ORDER BY turn, language, repository, source_type LIMIT 25""")
def curation_plan(spark, sf):
    r = _records(spark, sf)
    fine = r.join(R.first_rejection(r).where("rejection_code = ''").select("position"), "position", "left_semi")
    return corpus.round_robin(fine, ["language", "repository", "source_type"], "position", 25).select("position", "repository", "turn")


@query(W + "SELECT source_instance_id, arg_max(title, position) AS title, max(position) AS position FROM v_records WHERE source_instance_id <> '' GROUP BY 1")
def registry_upsert_latest(spark, sf):
    return R.latest(_records(spark, sf).where("source_instance_id <> ''").select("source_instance_id", "title", "position"), "source_instance_id", "position")


@query(W + """, j AS (SELECT position, source_instance_id, CASE WHEN source_instance_id = '' THEN 'missing instance id' WHEN title = '' THEN 'missing query' WHEN NOT regexp_full_match(revision, '[0-9a-f]{40}') THEN 'revision is not fixed' ELSE '' END AS issue FROM v_records),
 s AS (SELECT *, coalesce(sum(CASE WHEN issue = '' THEN 1 ELSE 0 END) OVER (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM j)
 SELECT position, CASE WHEN issue = '' THEN 'scenario_' || substr(sha256(source_instance_id), 1, 16) END AS scenario_id, issue FROM s WHERE done < 120""")
def source_import(spark, sf):
    return R.scenarios(_records(spark, sf), 120)
