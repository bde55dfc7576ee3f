"""Queries over what outlives a run: folder trees, recovery from the usage ledger, curated records, admission and test commands."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import commands as C
from trajlake.operators import curation as K
from trajlake.operators import jobs as J
from trajlake.operators import recovery as R
from trajlake.operators import trees as T
from trajlake.plans.registry import query
from trajlake.plans.strict_queries import _sql

#: Entries of trees, one tree per host: files, links and folders, some below .git, some beside it.
ENTRIES = """SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS tree_id, CASE WHEN page_id % 11 = 0 THEN '.git/' ELSE '' END || CASE WHEN page_id % 13 = 0 THEN '.gitx-' ELSE '' END
 || 'd' || CAST(page_id % 3 AS {s}) || CASE CAST(page_id % 4 AS INTEGER) WHEN 0 THEN '/' WHEN 1 THEN '-x/' WHEN 2 THEN '/a b/' ELSE '.' END || 'f"' || CAST(page_id AS {s}) AS path,
 CASE CAST(page_id % 5 AS INTEGER) WHEN 0 THEN 'dir' WHEN 1 THEN 'symlink' ELSE 'file' END AS kind, {h} AS sha256, '../' || CAST(page_id % 9 AS {s}) AS target FROM pages"""


@query(
    f"""WITH e AS ({ENTRIES.format(s='VARCHAR', h="sha256(coalesce(html, ''))")}), j AS (SELECT tree_id, string_split(path, '/') AS parts, '{{"path":"' || replace(path, '"', '\\"') || CASE kind WHEN 'file' THEN '","sha256":"' || sha256 WHEN 'symlink' THEN '","target":"' || target ELSE '' END || '","type":"' || kind || '"}}' AS one FROM e WHERE NOT path LIKE '.git/%')
 SELECT tree_id, count(*) AS entries, sha256('[' || string_agg(one, ',' ORDER BY parts) || ']') AS tree_sha256 FROM j GROUP BY 1"""
)
def tree_hashes(spark, sf):
    return T.tree_hashes(_sql(spark, sf, ["pages"], ENTRIES.format(s="STRING", h="sha2(coalesce(html, ''), 256)")))


_KNOWN = "CAST(o_orderkey % 4 - CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 47 = 3 THEN 2 ELSE 0 END AS INTEGER)"
JOBS = "SELECT CAST(o_orderkey AS {s}) AS job_id, CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'running' END AS status, CAST(o_orderkey % 4 AS INTEGER) AS attempts, o_orderkey % 17 <> 3 AS contracted FROM orders"
LEDGER = f"""SELECT CAST(o_orderkey AS {{s}}) AS job_id, a AS attempt, 'admitted' AS kind, CAST(NULL AS {{s}}) AS call_id, o_orderdate AS happened_at, CAST(NULL AS DOUBLE) AS latency_ms, CAST(NULL AS BIGINT) AS tokens, CAST(NULL AS DOUBLE) AS cost, CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1000000000000 ELSE 0 END AS DOUBLE) AS floor_ms FROM orders JOIN (VALUES (1), (2), (3), (4), (5)) t(a) ON a <= {_KNOWN}
 UNION ALL SELECT CAST(o_orderkey AS {{s}}), a, 'terminal', NULL, o_orderdate, NULL, NULL, NULL, NULL FROM orders JOIN (VALUES (1), (2), (3), (4), (5)) t(a) ON a < {_KNOWN} + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END WHERE NOT (o_orderkey % 29 = 1 AND a = 1)
 UNION ALL SELECT CAST(l_orderkey AS {{s}}), CAST({_KNOWN.replace('o_orderkey', 'l_orderkey')} AS INTEGER), k, CAST(l_partkey AS {{s}}) || k2, l_shipdate, CAST(CASE WHEN k = 'call_completed' THEN l_extendedprice END AS DOUBLE), CAST(CASE WHEN k = 'call_completed' THEN l_quantity END AS BIGINT), CAST(CASE WHEN k = 'call_completed' THEN l_discount END AS DOUBLE), NULL
 FROM lineitem JOIN (VALUES ('call_started', ''), ('call_completed', '')) t(k, k2) ON k = 'call_started' OR l_suppkey % 13 <> 0 WHERE {_KNOWN.replace('o_orderkey', 'l_orderkey')} > 0"""
SHOWN = "SELECT CAST(o_orderkey AS {s}) AS job_id, CASE WHEN o_orderkey % 2 = 0 THEN 'trace' ELSE 'report' END AS artifact FROM orders WHERE o_orderkey % 8 = 5 OR o_orderkey % 22 = 4"
NOW = "2001-06-01 00:00:00"


@query(
    f"""WITH j AS ({JOBS.format(s='VARCHAR')}), l AS ({LEDGER.format(s='VARCHAR')}), p AS (SELECT job_id, bool_or(artifact = 'trace') AS trace FROM ({SHOWN.format(s='VARCHAR')}) GROUP BY 1),
 c AS (SELECT job_id, attempt, call_id, count(*) FILTER (kind = 'call_started') AS st, count(*) FILTER (kind = 'call_completed') AS co, max(CAST(latency_ms AS DECIMAL(28,6))) AS lat, max(tokens) AS tok, max(CAST(cost AS DECIMAL(28,10))) AS cost, max(happened_at) FILTER (kind = 'call_completed') AS rec,
  min(happened_at) FILTER (kind = 'admitted') AS adm, max(CAST(floor_ms AS DECIMAL(28,6))) AS flo, count(*) FILTER (kind = 'terminal') AS en FROM l GROUP BY 1, 2, 3),
 a AS (SELECT job_id, attempt, min(adm) AS adm, coalesce(max(flo), 0) AS flo, count(*) FILTER (st > 0 AND co = 0) AS open_calls, coalesce(sum(lat), 0) AS lat, CAST(coalesce(sum(tok), 0) AS BIGINT) AS tok, coalesce(sum(cost), 0) AS cost, max(rec) AS rec, sum(en) > 0 AS ended FROM c GROUP BY 1, 2),
 k AS (SELECT job_id, count(*) AS known, count(*) FILTER (NOT ended) AS open, max(attempt) AS last FROM a GROUP BY 1),
 m AS (SELECT j.*, coalesce(known, 0) AS known, coalesce(open, 0) AS open, p.job_id IS NOT NULL AS residue, coalesce(trace, false) AS trace, a.* EXCLUDE (job_id) FROM j LEFT JOIN k USING (job_id) LEFT JOIN p USING (job_id) LEFT JOIN a ON a.job_id = j.job_id AND a.attempt = k.last WHERE status = 'running'),
 r AS (SELECT *, CASE WHEN NOT contracted THEN 'refused:outside_contract' WHEN attempts = 0 THEN 'refused:no_admission' WHEN trace THEN 'left:trace_published' WHEN attempts NOT IN (known, known + 1) THEN 'refused:attempt_count'
  WHEN attempts = known + 1 THEN CASE WHEN open > 0 THEN 'refused:open_attempt_before_gap' WHEN residue THEN 'refused:artifact_residue' ELSE 'recovered:admission_gap' END WHEN open = 0 THEN 'left:all_ended' WHEN open > 1 OR ended THEN 'refused:not_the_latest' WHEN residue THEN 'refused:artifact_residue'
  WHEN open_calls > 0 THEN 'refused:unknown_usage' WHEN adm > TIMESTAMP '{NOW}' OR coalesce(rec > TIMESTAMP '{NOW}', false) THEN 'refused:clock' ELSE 'recovered:interrupted' END AS reason FROM m)
 SELECT job_id, split_part(reason, ':', 1) AS action, split_part(reason, ':', 2) AS reason, CAST(CASE reason WHEN 'recovered:interrupted' THEN attempt WHEN 'recovered:admission_gap' THEN attempts END AS BIGINT) AS attempt, CASE reason WHEN 'recovered:interrupted' THEN tok WHEN 'recovered:admission_gap' THEN 0 END AS tokens,
 CAST(CASE reason WHEN 'recovered:interrupted' THEN cost WHEN 'recovered:admission_gap' THEN 0 END AS DOUBLE) AS cost, CASE reason WHEN 'recovered:interrupted' THEN CAST(greatest(CAST(epoch_us(TIMESTAMP '{NOW}') - epoch_us(adm) AS DECIMAL(28,6)) / 1000, lat, flo) AS DOUBLE) WHEN 'recovered:admission_gap' THEN 1200000.0 END AS elapsed_ms FROM r"""
)
def crash_recoveries(spark, sf):
    jobs, ledger, shown = (_sql(spark, sf, ["orders", "lineitem"], t.format(s="STRING")) for t in (JOBS, LEDGER, SHOWN))
    return R.recoveries(jobs, ledger, shown, F.lit(NOW).cast("timestamp"), 1200).withColumn("cost", F.col("cost").cast("double"))


TASKS = "SELECT 'task_' || CAST(doc_id AS {s}) AS task_id, 'src_' || CAST(doc_id % 700 AS {s}) AS source_instance_id FROM documents WHERE doc_id % 3 = 0"
SOURCES = "SELECT page_id, 'src_' || CAST(page_id AS {s}) AS source_instance_id, 'old' AS test_patch, {a1} AS test_commands, {a2} AS verifier_types FROM pages"
CURATED = """SELECT doc_id AS record_index, CASE WHEN doc_id % 17 = 0 THEN ' ' WHEN doc_id % 19 = 0 THEN 'other' ELSE 'task_' || CAST(doc_id - doc_id % 3 AS {s}) END AS task_id, CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 11 = 0 THEN 'src_x' ELSE 'src_' || CAST((doc_id - doc_id % 3) % 700 AS {s}) END AS source_instance_id,
 CASE WHEN doc_id % 7 = 0 THEN ' ' ELSE 'diff ' || CAST(doc_id AS {s}) END AS hidden_test_patch, {a3} AS hidden_test_commands, CASE WHEN doc_id % 5 = 0 THEN 'see the Hidden test' ELSE 'it works' END AS public_behavior_summary, CASE WHEN doc_id % 23 = 0 THEN NULL ELSE 'n' END AS withheld_evaluator_notes FROM documents"""
_LISTS = {"VARCHAR": {"a1": "['a']", "a2": "CASE WHEN page_id % 2 = 0 THEN ['unit_test'] ELSE ['hidden_test_patch', 'x'] END", "a3": "CASE WHEN doc_id % 29 = 0 THEN [] ELSE [' pytest ' || CAST(doc_id AS VARCHAR)] END"}}
_LISTS["STRING"] = {k: v.replace("['hidden_test_patch', 'x']", "array('hidden_test_patch', 'x')").replace("['unit_test']", "array('unit_test')").replace("['a']", "array('a')").replace("[]", "cast(array() as array<string>)").replace("[' pytest ' || CAST(doc_id AS VARCHAR)]", "array(' pytest ' || CAST(doc_id AS STRING))") for k, v in _LISTS["VARCHAR"].items()}


def _texts(s: str) -> list[str]:
    return [t.format(s=s, **_LISTS[s]) for t in (TASKS, SOURCES, CURATED)]


_t, _s, _c = _texts("VARCHAR")
PLACED = f"""t AS ({_t}), s AS ({_s}), c AS ({_c}), e AS (SELECT c.*, t.source_instance_id AS planned, list_filter(list_concat(CASE WHEN trim(c.source_instance_id) = '' THEN ['source_instance_id'] WHEN c.source_instance_id <> t.source_instance_id THEN ['other_source_instance_id'] ELSE [] END,
 [CASE WHEN contains(lower(public_behavior_summary), 'hidden test') THEN 'summary_holds:hidden test' END, CASE WHEN trim(hidden_test_patch) = '' THEN 'hidden_test_patch' END, CASE WHEN len(hidden_test_commands) = 0 THEN 'hidden_test_commands' END, CASE WHEN withheld_evaluator_notes IS NULL THEN 'withheld_evaluator_notes' END]), lambda x: x IS NOT NULL) AS errors
 FROM c LEFT JOIN t ON t.task_id = c.task_id), f AS (SELECT task_id, min(record_index) AS first FROM e WHERE planned IS NOT NULL AND len(errors) = 0 GROUP BY 1),
 v_placed AS (SELECT record_index, trim(e.task_id) AS task_id, CASE WHEN trim(e.task_id) = '' THEN 'invalid:no_task' WHEN planned IS NULL THEN 'unused:unknown_task' WHEN record_index = first THEN 'applied:' WHEN record_index > first THEN 'invalid:double' ELSE 'invalid:malformed' END AS reason, errors FROM e LEFT JOIN f ON f.task_id = e.task_id)"""


def _curated(spark, sf):
    tasks, sources, records = (_sql(spark, sf, ["documents", "pages"], t) for t in _texts("STRING"))
    return tasks, sources, records, K.buckets(tasks, records, K.patch_errors(hidden=("hidden test",)))


@query(f"WITH {PLACED} SELECT record_index, task_id, split_part(reason, ':', 1) AS bucket, split_part(reason, ':', 2) AS reason, CASE WHEN reason = 'invalid:malformed' THEN array_to_string(errors, ',') ELSE '' END AS errors FROM v_placed")
def curation_buckets(spark, sf):
    return _curated(spark, sf)[3].withColumn("errors", F.array_join("errors", ","))


@query(
    f"""WITH {PLACED}, g AS (SELECT t.source_instance_id, max(t.task_id) AS task_id FROM t GROUP BY 1), n AS (SELECT g.*, c.hidden_test_patch AS patch, c.hidden_test_commands AS cmds FROM g JOIN v_placed p ON p.task_id = g.task_id AND p.reason = 'applied:' JOIN c ON c.record_index = p.record_index)
 SELECT s.page_id, s.source_instance_id, coalesce(patch, test_patch) AS test_patch, array_to_string(CASE WHEN patch IS NULL THEN test_commands ELSE list_transform(cmds, lambda x: trim(x)) END, '|') AS test_commands,
 array_to_string(CASE WHEN patch IS NULL THEN verifier_types ELSE list_sort(list_distinct(list_append(verifier_types, 'hidden_test_patch'))) END, '|') AS verifier_types, n.task_id AS curation_task_id, sha256(patch) AS hidden_test_patch_sha256 FROM s LEFT JOIN n USING (source_instance_id)"""
)
def curation_applied(spark, sf):
    out = K.apply(*_curated(spark, sf))
    return out.withColumns({c: F.array_join(c, "|") for c in ("test_commands", "verifier_types")})


@query(
    f"""WITH {PLACED}, d AS (SELECT task_id FROM v_placed WHERE reason = 'applied:'), q AS (SELECT (SELECT count(*) FROM d) AS applied, (SELECT count(*) FROM v_placed WHERE reason LIKE 'invalid:%') AS invalid, (SELECT count(*) FROM v_placed WHERE reason LIKE 'unused:%') AS unused,
 (SELECT count(*) FROM t WHERE task_id NOT IN (SELECT task_id FROM d)) AS remaining, (SELECT count(DISTINCT source_instance_id) FROM t WHERE task_id IN (SELECT task_id FROM d) AND source_instance_id NOT IN (SELECT source_instance_id FROM s)) AS absent_sources)
 SELECT *, invalid = 0 AND absent_sources = 0 AS valid, invalid = 0 AND absent_sources = 0 AND applied > 0 AS ready FROM q"""
)
def curation_summary(spark, sf):
    tasks, sources, _, placed = _curated(spark, sf)
    return K.summary(tasks, sources, placed)


SPENT = "SELECT o_orderkey AS n, CAST(o_orderkey AS {s}) AS job_id, CAST(o_custkey % 97 AS BIGINT) AS tokens, CAST(o_totalprice AS BIGINT) AS cost_cents, CAST(o_custkey % 13 AS BIGINT) AS seconds FROM orders"
BUDGETS = {"tokens": (150_000, 120), "cost_cents": (400_000_000, 0), "seconds": (9_000_000, 60)}


@query(
    f"""WITH j AS (SELECT *, row_number() OVER (ORDER BY n) AS position, coalesce(sum(tokens) OVER w, 0) AS dt, coalesce(sum(cost_cents) OVER w, 0) AS dc, coalesce(sum(seconds) OVER w, 0) AS ds FROM ({SPENT.format(s='VARCHAR')}) WINDOW w AS (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 4 PRECEDING)),
 r AS (SELECT *, list_filter([CASE WHEN dt >= 150000 THEN 'tokens_spent' END, CASE WHEN dt + (least(3, position - 1) + 1) * 120 > 150000 THEN 'tokens_reserved' END, CASE WHEN dc >= 400000000 THEN 'cost_cents_spent' END, CASE WHEN ds >= 9000000 THEN 'seconds_spent' END, CASE WHEN ds + (least(3, position - 1) + 1) * 60 > 9000000 THEN 'seconds_reserved' END], lambda x: x IS NOT NULL) AS reasons FROM j),
 s AS (SELECT min(position) AS stop FROM r WHERE len(reasons) > 0) SELECT job_id, position, stop IS NULL OR position < stop AS admitted, CASE WHEN position = stop THEN array_to_string(reasons, ',') ELSE '' END AS reasons FROM r, s"""
)
def reserved_admission(spark, sf):
    return J.reserved_prefix(_sql(spark, sf, ["orders"], SPENT.format(s="STRING")), BUDGETS, "n", settle=4).withColumn("reasons", F.array_join("reasons", ","))


_IDS = """SELECT p_partkey, {l}(p_name || '.py::test_' || CAST(p_size AS {s}), p_brand || '[a-1]', p_brand || '[b-2]', CASE WHEN p_partkey % 7 = 0 THEN '-x' WHEN p_partkey % 11 = 0 THEN 'a' || chr(10) || 'b' ELSE 'it''s ' || p_type END) AS ids,
 CASE CAST(p_partkey % 5 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN 'pytest {{test}} -q' WHEN 2 THEN 'run {{{{x}}}} {{test}}' WHEN 3 THEN 'bad {{name}} {{test}}' ELSE 'all' END AS template FROM part"""
_quote = "CASE WHEN regexp_full_match(y, '[A-Za-z0-9_@%+=:,./-]+') THEN y ELSE '''' || replace(y, '''', '''\"''\"''') || '''' END"


@query(
    f"""WITH p AS ({_IDS.format(l='list_value', s='VARCHAR')}), f AS (SELECT *, CASE WHEN template = '' THEN '' WHEN p_partkey % 7 = 0 THEN 'option' WHEN p_partkey % 11 = 0 THEN 'control_character' WHEN p_partkey % 5 = 3 THEN 'template' ELSE '' END AS fault FROM p),
 c AS (SELECT p_partkey, fault, CASE WHEN template = '' OR fault <> '' THEN [] ELSE list_transform(list_transform(list_transform(ids, lambda x: split_part(x, '[', 1)), lambda y: {_quote}), lambda z: replace(replace(replace(template, '{{test}}', z), '{{{{', '{{'), '}}}}', '}}')) END AS cs FROM f)
 SELECT p_partkey, fault, array_to_string(list_filter(cs, lambda v, i: list_position(cs, v) = i), ' ; ') AS commands FROM c"""
)
def hidden_test_commands(spark, sf):
    made = _sql(spark, sf, ["part"], _IDS.format(l="array", s="STRING")).select("p_partkey", C.test_commands(F.col("ids"), F.col("template")).alias("c"))
    return made.select("p_partkey", "c.fault", F.array_join("c.commands", " ; ").alias("commands"))


#: Records of pages with commands of several kinds, some as lists, some as texts, some doubled or blank.
VERIFIED = """SELECT page_id, '{"language":"go","coverage_tags":["b","a"]' || CASE CAST(page_id % 4 AS INTEGER) WHEN 0 THEN ',"hidden_tests":null,"test_commands":["run a"," run a ","run b"]' WHEN 1 THEN ',"eval_commands":"eval"' WHEN 2 THEN ',"hidden_tests":[],"test_commands":["never"]' ELSE '' END
 || CASE CAST(page_id % 3 AS INTEGER) WHEN 0 THEN ',"FAIL_TO_PASS":["t::x[1]","t::x[2]"]' WHEN 1 THEN ',"test_ids":["-bad","ok"]' ELSE '' END || CASE WHEN page_id % 5 = 0 THEN ',"build_commands":["make",""]' WHEN page_id % 5 = 1 THEN ',"doctest_commands":"run a"' ELSE '' END
 || CASE WHEN page_id % 7 = 0 THEN ',"required_state":{"a":1},"patch":"diff"' WHEN page_id % 7 = 1 THEN ',"required_state":{},"test_patch":" ","performance_threshold":0,"diff_constraints":["x"]' ELSE ',"trace_quality_rubric":null' END || CASE WHEN page_id % 11 = 0 THEN ',"verifier_types":["Unit Test","build-command"]' ELSE '' END || '}' AS raw FROM pages"""
_hid = "list_concat(CASE CAST(page_id % 4 AS INTEGER) WHEN 0 THEN ['run a', 'run b'] WHEN 1 THEN ['eval'] ELSE [] END, CASE WHEN page_id % 3 = 0 THEN ['pytest t::x'] ELSE [] END)"
_build, _doc = "CASE WHEN page_id % 5 = 0 THEN ['make'] ELSE [] END", "CASE WHEN page_id % 5 = 1 THEN ['run a'] ELSE [] END"


@query(
    f"""WITH g AS (SELECT page_id, {_build} AS b, {_doc} AS d, {_hid} AS h FROM pages), t AS (SELECT *, list_sort(list_distinct(list_filter([CASE WHEN len(b) > 0 OR page_id % 11 = 0 THEN 'build_command' END, CASE WHEN len(d) > 0 THEN 'doctest' END, CASE WHEN len(h) > 0 THEN 'hidden_command' END, CASE WHEN page_id % 7 = 0 THEN 'required_state' END, CASE WHEN page_id % 7 = 0 THEN 'reference_patch' END,
 CASE WHEN page_id % 7 = 1 THEN 'performance_threshold' END, CASE WHEN page_id % 7 = 1 THEN 'diff_constraint' END, CASE WHEN page_id % 11 = 0 THEN 'unit_test' END], lambda x: x IS NOT NULL))) AS types, list_concat(b, list_concat(d, h)) AS cs FROM g)
 SELECT page_id, array_to_string(list_filter(cs, lambda x, i: list_position(cs, x) = i), ';') AS commands, array_to_string(types, ',') AS verifier_types, array_to_string(list_sort(list_concat(['a', 'b', 'more', 'language:go', 'source_format:swe', 'task_family:repair'], list_concat(CASE WHEN page_id % 2 = 0 THEN ['repo:o/n'] ELSE [] END, list_transform(types, lambda x: 'verifier:' || x)))), ',') AS tags FROM t"""
)
def record_verifiers(spark, sf):
    r = _sql(spark, sf, ["pages"], VERIFIED).select("page_id", F.try_parse_json("raw").alias("v"))
    r = r.withColumn("groups", C.command_groups(F.col("v"), F.lit("pytest {test}")))
    r = r.withColumn("types", C.verifier_types(F.col("v"), F.col("groups")))
    repository = F.when(F.col("page_id") % 2 == 0, "o/n").otherwise("")
    tags = C.coverage_tags(F.col("v"), F.lit("repair"), F.lit("swe"), repository, F.col("types"), F.array(F.lit("more"), F.lit("a")))
    return r.select("page_id", F.array_join(C.all_commands(F.col("groups")), ";").alias("commands"), F.array_join("types", ",").alias("verifier_types"), F.array_join(tags, ",").alias("tags"))
