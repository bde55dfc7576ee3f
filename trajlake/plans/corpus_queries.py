"""Queries over seed corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions.text import label_list, normalized_query
from trajlake.operators import corpus as C
from trajlake.plans import adapters as A
from trajlake.plans.registry import query

W = f"WITH {A.SEEDS} "
NORM = "array_to_string(regexp_extract_all(lower(query), '[a-z0-9]+'), ' ')"
ACCEPTED = {"bug_repair": ["hidden_command", "unit_test"], "feature": ["unit_test"], "refactor": ["hidden_command"], "docs_examples": ["required_state"], "performance": ["hidden_command"], "code_review": ["unit_test", "required_state"]}
FITS = " OR ".join(f"(task_family = '{f}' AND len(list_intersect(verifier_types, [{', '.join(repr(k) for k in ks)}])) > 0)" for f, ks in ACCEPTED.items())


@query(W + f"SELECT seed_id, md5({NORM}) AS query_md5, len(string_split({NORM}, ' ')) AS n_tokens FROM v_seeds")
def normalized_query_(spark, sf):
    n = normalized_query(F.col("query"))
    return A.seeds(spark, sf).select("seed_id", F.md5(n.cast("binary")).alias("query_md5"), F.size(F.split(n, " ")).cast("long").alias("n_tokens"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([translate(lower(trim(x)), '- ', '__') FOR x IN [p_name, p_brand, ' ' || p_type || '-x', '', p_brand]], lambda x: x <> ''))), ',') AS labels FROM part")
def normalize_labels(spark, sf):
    p = A.table(spark, sf, "part")
    return p.select("p_partkey", F.array_join(label_list(F.array("p_name", "p_brand", F.concat(F.lit(" "), "p_type", F.lit("-x")), F.lit(""), "p_brand")), ",").alias("labels"))


@query(W + f"SELECT sha256({NORM}) AS query_hash, count(*) AS seeds, min(seed_id) AS first_seed, max(seed_id) AS last_seed FROM v_seeds GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, sf):
    return C.exact_duplicates(A.seeds(spark, sf))


@query(
    W + """, c AS (SELECT min(seed_id) AS rep, toks FROM (SELECT seed_id, list_sort(list_distinct(list_filter(regexp_extract_all(lower(query), '[a-z0-9]+'), lambda t: NOT regexp_matches(t, '^[0-9]+$')))) AS toks FROM v_seeds) WHERE len(toks) > 0 GROUP BY toks),
 t AS (SELECT rep, len(toks) AS n, unnest(toks) AS tok FROM c), p AS (SELECT a.rep AS l, b.rep AS r, any_value(a.n) AS ln, any_value(b.n) AS rn, count(*) AS s FROM t a JOIN t b ON a.tok = b.tok AND a.rep < b.rep GROUP BY 1, 2)
 SELECT l AS left_id, r AS right_id, round(s / CAST(ln + rn - s AS DOUBLE), 6) AS jaccard FROM p WHERE 10 * s >= 8 * (ln + rn - s)"""
)
def semantic_duplicates(spark, sf):
    d = A.table(spark, sf, "documents")  # labels add no seed
    return C.semantic_duplicates(d.select(F.concat(F.lit("seed_"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("seed_id"), F.col("text").alias("query")))


DIMS = ["split", "task_family", "source_method", "language", "repository", "difficulty"]


@query(
    W + ", d AS (" + " UNION ALL ".join(f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value, train_eligible FROM v_seeds" for c in DIMS) + " UNION ALL SELECT 'verifier_types', unnest(verifier_types), train_eligible FROM v_seeds) SELECT dimension, value, count(*) AS seeds, count(*) FILTER (train_eligible) AS trainable FROM d GROUP BY 1, 2"
)
def seed_dimension_counts(spark, sf):
    return C.dimension_counts(A.seeds(spark, sf), DIMS, ["verifier_types"])


@query(
    W + f""", i AS (SELECT seed_id, unnest(list_filter([CASE WHEN length(trim(query)) = 0 THEN 'empty_query' END, CASE WHEN language = '' THEN 'missing_language' END, CASE WHEN len(verifier_types) = 0 THEN 'missing_verifier' END,
 CASE WHEN train_eligible AND NOT ({FITS}) THEN 'family_verifier_mismatch' END, CASE WHEN train_eligible AND source_method LIKE '%benchmark%' THEN 'benchmark_marked_trainable' END], lambda x: x IS NOT NULL)) AS code FROM v_seeds) SELECT * FROM i"""
)
def seed_audit_issues(spark, sf):
    return C.audit_issues(A.seeds(spark, sf), ACCEPTED)


def _gate(column: str, cap: float) -> str:
    return f"""SELECT '{column}_share' AS code, label, round(n / CAST(total AS DOUBLE), 6) AS value FROM (SELECT {column} AS label, count(*) AS n, min(seed_id) AS f FROM v_seeds WHERE train_eligible AND {column} <> '' GROUP BY 1 ORDER BY n DESC, f LIMIT 1),
 (SELECT count(*) AS total FROM v_seeds WHERE train_eligible) WHERE n > {cap} * total"""


@query(W + "SELECT 'too_few_trainable' AS code, '' AS label, CAST(n AS DOUBLE) AS value FROM (SELECT count(*) AS n FROM v_seeds WHERE train_eligible) WHERE n < 1000 UNION ALL " + " UNION ALL ".join(f"({_gate(c, s)})" for c, s in (("task_family", 0.1), ("language", 0.5), ("repository", 0.9), ("source_method", 0.2))))
def seed_policy_gates(spark, sf):
    return C.policy_gates(A.seeds(spark, sf), 1000, {"task_family": 0.1, "language": 0.5, "repository": 0.9, "source_method": 0.2})


@query(W + "SELECT label, n, round(n / CAST(total AS DOUBLE), 6) AS share, CAST(ceil(n / 0.15) - total AS BIGINT) AS additional_rows FROM (SELECT language AS label, count(*) AS n FROM v_seeds WHERE train_eligible GROUP BY 1), (SELECT count(*) AS total FROM v_seeds WHERE train_eligible) WHERE n > 0.15 * total")
def dominance_gaps(spark, sf):
    return C.dominance_gaps(A.seeds(spark, sf), "language", 0.15)


REQUIRED = [("task_family", "bug_repair", 500), ("task_family", "planning", 5), ("language", "es", 10), ("language", "it", 3), ("verifier_types", "required_state", 900)]
_required = ", ".join(f"('{d}', '{v}', CAST({m} AS BIGINT))" for d, v, m in REQUIRED)


def _gaps(spark, sf):
    required = spark.createDataFrame(REQUIRED, "dimension string, value string, minimum long")
    return C.minimum_gaps(C.dimension_counts(A.seeds(spark, sf), ["task_family", "language"], ["verifier_types"]), required)


_GAPS = W + f""", d AS (SELECT 'task_family' AS dimension, task_family AS value, train_eligible FROM v_seeds UNION ALL SELECT 'language', language, train_eligible FROM v_seeds UNION ALL SELECT 'verifier_types', unnest(verifier_types), train_eligible FROM v_seeds),
 n AS (SELECT dimension, value, count(*) FILTER (train_eligible) AS trainable FROM d GROUP BY 1, 2), q(dimension, value, minimum) AS (VALUES {_required}),
 g AS (SELECT dimension, value, coalesce(trainable, 0) AS actual, minimum, minimum - coalesce(trainable, 0) AS gap FROM q LEFT JOIN n USING (dimension, value) WHERE coalesce(trainable, 0) < minimum)"""


@query(_GAPS + " SELECT * FROM g")
def backfill_gaps(spark, sf):
    return _gaps(spark, sf)


@query(_GAPS + " SELECT dimension, count(*) AS short_labels, CAST(sum(gap) AS BIGINT) AS missing FROM g GROUP BY 1")
def coverage_budget(spark, sf):
    return _gaps(spark, sf).groupBy("dimension").agg(F.count("*").alias("short_labels"), F.sum("gap").alias("missing"))


@query(W + f"SELECT task_family, count(*) AS trainable, count(*) FILTER ({FITS}) AS verified FROM v_seeds WHERE train_eligible GROUP BY 1")
def family_verifier_gap(spark, sf):
    return C.family_gap(A.seeds(spark, sf), ACCEPTED)


KEYS = {"query": f"sha256({NORM})", "provenance": "provenance", "repository": "repository"}


@query(
    W + ", k AS (" + " UNION ALL ".join(f"SELECT seed_id, train_eligible, '{k}' AS kind, {e} AS key FROM v_seeds" for k, e in KEYS.items()) + """), h AS (SELECT * FROM k WHERE NOT train_eligible AND key <> '')
 SELECT k.seed_id, k.kind, count(*) AS matches, CASE WHEN k.kind = 'repository' THEN 'warning' ELSE 'error' END AS severity FROM k JOIN h ON k.kind = h.kind AND k.key = h.key AND k.seed_id <> h.seed_id WHERE k.train_eligible AND k.key <> '' GROUP BY 1, 2"""
)
def seed_decontamination(spark, sf):
    s = A.seeds(spark, sf)
    keys = {"query": F.sha2(normalized_query(F.col("query")), 256), "provenance": F.col("provenance"), "repository": F.col("repository")}
    return C.contamination(s, s.where("not train_eligible"), keys, ("repository",))


@query(
    W + """, k AS (SELECT seed_id AS id, split, unnest(list_transform(verifier_types, lambda v: v || '|' || CAST(doc_id % 97 AS VARCHAR))) AS key FROM v_seeds)
 SELECT l.id, count(DISTINCT l.key) AS overlap_keys, count(*) AS holdouts FROM k l JOIN k r ON l.key = r.key AND l.id <> r.id WHERE l.split = 'train' AND r.split = 'evaluation' GROUP BY 1"""
)
def scenario_decontamination(spark, sf):
    k = A.seeds(spark, sf).select(F.col("seed_id").alias("id"), "split", F.explode(F.transform("verifier_types", lambda v: F.concat(v, F.lit("|"), (F.col("doc_id") % 97).cast("string")))).alias("key"))
    return C.key_overlap(k.where("split = 'train'").select("id", "key"), k.where("split = 'evaluation'").select("id", "key"))


@query(W + f"SELECT sha256({NORM}) AS key_hash, count(*) FILTER (split = 'train') AS left_rows, count(*) FILTER (split = 'evaluation') AS right_rows FROM v_seeds WHERE split IN ('train', 'evaluation') GROUP BY 1 HAVING left_rows > 0 AND right_rows > 0")
def split_leakage(spark, sf):
    return C.split_leakage(A.seeds(spark, sf), normalized_query(F.col("query")))


@query(
    """WITH v AS (SELECT item_id AS value_id, text AS value FROM benchmark), p AS (SELECT value_id, value, regexp_extract_all(value, '(?:[A-Za-z0-9_.-]+/)+[A-Za-z0-9_.-]+') AS paths FROM v),
 f AS (SELECT value_id, unnest(list_concat(paths, list_transform(paths, lambda x: regexp_replace(x, '.*/', '')), list_filter(regexp_extract_all(value, '[0-9a-fA-F]{64,}'), lambda x: len(x) = 64), list_filter(regexp_extract_all(value, '[A-Za-z0-9_.-]{8,}'), lambda x: regexp_matches(lower(x), 'hidden|private|secret|evaluator')))) AS value FROM p)
 SELECT DISTINCT value_id, doc_id AS text_id FROM (SELECT * FROM v UNION SELECT * FROM f WHERE len(value) >= 8) s JOIN documents d ON contains(d.text, s.value)"""
)
def cross_corpus_leaks(spark, sf):
    values = A.table(spark, sf, "benchmark").select(F.col("item_id").alias("value_id"), F.col("text").alias("value"))
    return C.passage_leaks(values.union(C.sensitive_fragments(values)).distinct(), A.table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text")).distinct()


@query(W + ", x AS (SELECT seed_id, task_family, language, CASE WHEN len(verifier_types) = 0 THEN ['none'] ELSE verifier_types END AS v FROM v_seeds), s AS (SELECT seed_id, task_family, language, unnest(v) AS verifier FROM x) SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY task_family, language, verifier ORDER BY seed_id) AS INTEGER) AS rank FROM s) WHERE rank <= 3")
def stratified_review_sample(spark, sf):
    kinds = F.when(F.size("verifier_types") == 0, F.array(F.lit("none"))).otherwise(F.col("verifier_types"))
    return C.stratified(A.seeds(spark, sf).select("seed_id", "task_family", "language", F.explode(kinds).alias("verifier")), ["task_family", "language", "verifier"], "seed_id", 3)


@query(W + "SELECT seed_id, language, repository, source_method, CAST(turn AS INTEGER) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY language, repository, source_method ORDER BY seed_id) AS turn FROM v_seeds) ORDER BY turn, language, repository, source_method LIMIT 150")
def balanced_round_robin(spark, sf):
    return C.round_robin(A.seeds(spark, sf).select("seed_id", "language", "repository", "source_method"), ["language", "repository", "source_method"], "seed_id", 150)


@query(W + "SELECT seed_id, source_method LIKE 'benchmark%' OR repository IN ('src3', 'src5') AS benchmark, NOT (source_method LIKE 'benchmark%' OR repository IN ('src3', 'src5')) AND train_eligible AS default_trainable FROM v_seeds")
def benchmark_source_flag(spark, sf):
    flag = F.col("source_method").startswith("benchmark") | F.col("repository").isin("src3", "src5")
    return A.seeds(spark, sf).select("seed_id", flag.alias("benchmark"), (~flag & F.col("train_eligible")).alias("default_trainable"))
