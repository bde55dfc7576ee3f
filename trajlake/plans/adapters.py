"""Views that rename the driver's tables into the operators' input schemas, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job rows from orders: some scenarios are blank, some metrics are missing."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending").otherwise("infrastructure_failed")
    success = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    metrics = F.map_filter(
        F.create_map(
            F.lit("tool_calls"), (F.col("o_orderkey") % 12).cast("double"),
            F.lit("verifier_hidden_command_passed"), F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_orderkey") % 3 == 0).cast("double")),
            F.lit("verifier_all_non_agent_passed"), (F.col("o_orderkey") % 2).cast("double"),
            F.lit("verifier_agent_termination_passed"), (F.col("o_orderkey") % 4 != 0).cast("double"),
        ),
        lambda _, v: v.isNotNull(),
    )
    return o.select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.when(F.col("o_custkey") % 97 == 0, "").otherwise(F.concat(F.lit("scenario_"), F.col("o_custkey").cast("string"))).alias("scenario_id"),
        status.alias("status"),
        success.cast("int").alias("success"),
        F.floor("o_totalprice").cast("long").alias("tokens"),
        F.col("o_orderpriority").alias("goal_type"),
        F.concat(F.lit("t"), (F.col("o_orderkey") % 5000).cast("string")).alias("trace_id"),
        (F.col("o_orderkey") % 4).cast("int").alias("attempts"),
        metrics.alias("metrics"),
        F.col("o_orderdate").alias("created_at"),
    )


JOBS = """v_jobs AS (SELECT CAST(o_orderkey AS VARCHAR) AS job_id,
 CASE WHEN o_custkey % 97 = 0 THEN '' ELSE 'scenario_' || CAST(o_custkey AS VARCHAR) END AS scenario_id,
 CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'infrastructure_failed' END AS status,
 CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS success,
 CAST(floor(o_totalprice) AS BIGINT) AS tokens, o_orderpriority AS goal_type, 't' || CAST(o_orderkey % 5000 AS VARCHAR) AS trace_id,
 CAST(o_orderkey % 4 AS INTEGER) AS attempts, CAST(o_orderkey % 12 AS DOUBLE) AS m_tool_calls,
 CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE 0.0 END END AS m_hidden,
 CAST(o_orderkey % 2 AS DOUBLE) AS m_all, CASE WHEN o_orderkey % 4 <> 0 THEN 1.0 ELSE 0.0 END AS m_stop, o_orderdate AS created_at FROM orders)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls from lineitem: token usage of each call of a job."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("job_id"),
        F.col("l_linenumber").cast("int").alias("call_index"),
        F.col("l_partkey").alias("part"),
        F.round(F.col("l_quantity") * 100).cast("long").alias("prompt_tokens"),
        F.round(F.col("l_discount") * 1000).cast("long").alias("cached_tokens"),
        F.round(F.col("l_tax") * 1000).cast("long").alias("completion_tokens"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").alias("happened_at"),
    )


CALLS = """v_calls AS (SELECT CAST(l_orderkey AS VARCHAR) AS job_id, CAST(l_linenumber AS INTEGER) AS call_index, l_partkey AS part,
 CAST(round(l_quantity * 100) AS BIGINT) AS prompt_tokens, CAST(round(l_discount * 1000) AS BIGINT) AS cached_tokens,
 CAST(round(l_tax * 1000) AS BIGINT) AS completion_tokens, l_returnflag AS flag, l_shipdate AS happened_at FROM lineitem)"""


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace events from the event stream: a session per user, its events in order of time."""
    e = table(spark, sf_dir, "events")
    sequence = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    kind = F.create_map(*[F.lit(x) for p in (("view", "model_response"), ("click", "tool_requested"), ("purchase", "tool_finished"), ("error", "tool_finished"), ("signup", "policy_decision")) for x in p])
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"),
        sequence.cast("int").alias("sequence"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        F.element_at(kind, F.col("event_type")).alias("event_type"),
        F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("c"), (k % 6).cast("string"))).alias("call_id"),
        F.element_at(F.array(*[F.lit(x) for x in TOOLS]), (k % 6 + 1).cast("int")).alias("tool"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").alias("tool_status"),
        F.when(F.col("event_type") == "signup", F.when(k % 3 == 0, "deny").otherwise("allow")).alias("decision"),
        F.when(F.col("event_type") == "view", F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("answer "), k.cast("string")))).alias("content"),
        F.round(F.col("value") * 10).cast("long").alias("total_tokens"),
        F.col("ts").alias("happened_at"),
    )


#: Tool names of the trace view.
TOOLS = ["read_file", "search_files", "apply_patch", "run_tests", "list_files", "ask_user"]
_tools = "[" + ", ".join(f"'{t}'" for t in TOOLS) + "]"
TRACE = f"""v_raw AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
v_trace AS (SELECT 's' || CAST(user_id AS VARCHAR) AS session_id,
 CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS sequence, 'e' || CAST(event_id AS VARCHAR) AS event_id,
 CASE event_type WHEN 'view' THEN 'model_response' WHEN 'click' THEN 'tool_requested' WHEN 'signup' THEN 'policy_decision' ELSE 'tool_finished' END AS event_type,
 CASE WHEN k % 6 = 0 THEN '' ELSE 'c' || CAST(k % 6 AS VARCHAR) END AS call_id, ({_tools})[k % 6 + 1] AS tool,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' END AS tool_status,
 CASE WHEN event_type = 'signup' THEN CASE WHEN k % 3 = 0 THEN 'deny' ELSE 'allow' END END AS decision,
 CASE WHEN event_type = 'view' THEN CASE WHEN k % 4 = 0 THEN '' ELSE 'answer ' || CAST(k AS VARCHAR) END END AS content,
 CAST(round(value * 10) AS BIGINT) AS total_tokens, ts AS happened_at FROM v_raw)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.concat(F.lit("s"), F.col("conv_id").cast("string")).alias("session_id"), F.col("turn").cast("int").alias("sequence"), "role", F.col("text").alias("content"))


MESSAGES = "v_msgs AS (SELECT 's' || CAST(conv_id AS VARCHAR) AS session_id, CAST(turn AS INTEGER) AS sequence, role, text AS content FROM conversations)"


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task seeds from documents and their labels."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    family = F.element_at(F.array(*[F.lit(x) for x in FAMILIES]), (F.col("doc_id") % 6 + 1).cast("int"))
    eligible = F.coalesce(F.col("quality"), F.lit(1)) == 1
    split = F.when(F.col("doc_id") % 10 == 0, "evaluation").when(F.col("doc_id") % 10 == 1, "quarantined").otherwise("train")
    return d.select(
        F.concat(F.lit("seed_"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("seed_id"),
        F.col("doc_id"),
        F.col("text").alias("query"),
        F.coalesce("lang", F.lit("")).alias("language"),
        F.coalesce("source", F.lit("")).alias("repository"),
        split.alias("split"),
        (eligible & (split == "train")).alias("train_eligible"),
        family.alias("task_family"),
        F.when(F.col("doc_id") % 7 == 0, "benchmark_import").when(F.col("doc_id") % 3 == 0, "public_issue").otherwise("public_pull_request").alias("source_method"),
        F.array_compact(F.array(F.when(F.col("doc_id") % 2 == 0, "hidden_command"), F.when(F.col("doc_id") % 3 == 0, "unit_test"), F.when(F.coalesce("toxic", F.lit(0)) == 1, "required_state"))).alias("verifier_types"),
        (F.col("doc_id") % 5 + 1).cast("int").alias("difficulty"),
        F.concat(F.lit("src:"), (F.col("doc_id") % 400).cast("string")).alias("provenance"),
    )


FAMILIES = ["bug_repair", "feature", "refactor", "docs_examples", "performance", "code_review"]
_families = "[" + ", ".join(f"'{t}'" for t in FAMILIES) + "]"
SEEDS = f"""v_seeds AS (SELECT *, eligible AND split = 'train' AS train_eligible FROM (SELECT 'seed_' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS seed_id, doc_id, text AS query,
 coalesce(lang, '') AS language, coalesce(source, '') AS repository,
 CASE WHEN doc_id % 10 = 0 THEN 'evaluation' WHEN doc_id % 10 = 1 THEN 'quarantined' ELSE 'train' END AS split, coalesce(quality, 1) = 1 AS eligible,
 ({_families})[doc_id % 6 + 1] AS task_family,
 CASE WHEN doc_id % 7 = 0 THEN 'benchmark_import' WHEN doc_id % 3 = 0 THEN 'public_issue' ELSE 'public_pull_request' END AS source_method,
 list_filter([CASE WHEN doc_id % 2 = 0 THEN 'hidden_command' END, CASE WHEN doc_id % 3 = 0 THEN 'unit_test' END, CASE WHEN coalesce(toxic, 0) = 1 THEN 'required_state' END], lambda x: x IS NOT NULL) AS verifier_types,
 CAST(doc_id % 5 + 1 AS INTEGER) AS difficulty, 'src:' || CAST(doc_id % 400 AS VARCHAR) AS provenance FROM documents LEFT JOIN labels USING (doc_id)))"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Public source records from pages: repository is the host, number comes from the path."""
    p = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    kind = F.element_at(F.array(*[F.lit(x) for x in KINDS]), (F.col("page_id") % 4 + 1).cast("int"))
    return p.select(
        F.col("page_id").alias("position"),
        F.when(F.col("page_id") % 11 == 0, "").otherwise(F.concat(host, F.lit("#"), (F.col("page_id") % 180).cast("string"))).alias("source_instance_id"),
        host.alias("repository"),
        F.col("url").alias("source_url"),
        F.when(F.col("page_id") % 13 == 0, "main").otherwise(F.sha1(F.col("url").cast("binary"))).alias("revision"),
        F.when(F.col("page_id") % 9 == 0, "").otherwise(F.concat(F.lit("Fix "), F.regexp_extract("url", r"([0-9]+)", 1), F.element_at(F.array(*[F.lit(x) for x in TITLES]), (F.col("page_id") % 5 + 1).cast("int")))).alias("title"),
        kind.alias("source_type"),
        F.element_at(F.array(*[F.lit(x) for x in LICENSES]), (F.col("page_id") % 6 + 1).cast("int")).alias("license"),
        F.regexp_extract("url", r"/([a-z][a-z])/", 1).alias("language"),
        (F.col("page_id") % 3 == 0).alias("has_verifier"),
    )


KINDS = ["issue", "pull_request", "ci_run", ""]
TITLES = [" slow benchmark", " docs typo", " crash on start", " add option", " refactor core"]
LICENSES = ["MIT", "Apache-2.0", "GPL-3.0", "BSD-3-Clause", "", "mit"]


def _sql_list(values: list[str]) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + "])"


RECORDS = f"""v_records AS (SELECT page_id AS position, CASE WHEN page_id % 11 = 0 THEN '' ELSE regexp_extract(url, '^https?://([^/?#]+)', 1) || '#' || CAST(page_id % 180 AS VARCHAR) END AS source_instance_id,
 regexp_extract(url, '^https?://([^/?#]+)', 1) AS repository, url AS source_url, CASE WHEN page_id % 13 = 0 THEN 'main' ELSE sha1(url) END AS revision,
 CASE WHEN page_id % 9 = 0 THEN '' ELSE 'Fix ' || regexp_extract(url, '([0-9]+)', 1) || {_sql_list(TITLES)}[page_id % 5 + 1] END AS title,
 {_sql_list(KINDS)}[page_id % 4 + 1] AS source_type, {_sql_list(LICENSES)}[page_id % 6 + 1] AS license, regexp_extract(url, '/([a-z][a-z])/', 1) AS language,
 page_id % 3 = 0 AS has_verifier FROM pages)"""


def allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved repositories: every host whose name does not begin with "m."."""
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return table(spark, sf_dir, "pages").select(host.alias("repository"), F.col("page_id").alias("position")).where(~F.col("repository").startswith("m.")).select("repository", F.when(F.col("position") % 17 == 0, "GPL-3.0").otherwise("MIT").alias("license"), "position")


ALLOW = """v_allow AS (SELECT repository, CASE WHEN position % 17 = 0 THEN 'GPL-3.0' ELSE 'MIT' END AS license, position FROM
 (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS repository, page_id AS position FROM pages) WHERE repository NOT LIKE 'm.%')"""
