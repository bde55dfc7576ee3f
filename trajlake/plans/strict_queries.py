"""Checks of dynamic records: strict events and their order, fields, allowlists, pricing and selections."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from trajlake.functions import fields as X
from trajlake.operators import events as E
from trajlake.operators import records as R
from trajlake.operators import traces as T
from trajlake.operators import usage as U
from trajlake.plans import adapters as A
from trajlake.plans.registry import query


#: Casts of doubles to whole numbers: DuckDB takes the nearest, of two the even one, where Spark would cut.
WHOLE = re.compile(r"CAST\(((?:o_totalprice|l_quantity)[^()]*) AS BIGINT\)")


def _sql(spark, sf, tables: list[str], text: str):
    """A view over the driver's tables in SQL that both engines read alike."""
    for t in tables:
        A.table(spark, sf, t).createOrReplaceTempView(t)
    return spark.sql(WHOLE.sub(r"CAST(rint(\1) AS BIGINT)", text))


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


KINDS = [*E.REQUIRED, "unknown_kind"]
KIND = "CASE CAST(event_id % 14 AS INTEGER) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(KINDS)) + " ELSE 'model_response' END"
CALL = "'{\"function\":{\"name\":\"t' || CAST({m} % 3 AS {s}) || '\"},\"id\":\"c' || CAST({m} % 7 AS {s}) || '\"}'"


def _payloads(s: str) -> str:
    """Raw events of the stream: session, sequence, type, payload as spelled and in canonical form, and version; ``s`` is the text type.

    Some payloads are spelled with blanks, another order of fields and a letter beyond ASCII, some session ids hold a quote.
    """

    def text(n: str) -> str:
        return f"CAST({n} AS {s})"

    call, other = (CALL.replace("{m}", m).replace("{s}", s) for m in ("event_id", "(event_id + event_id % 2)"))
    mid = f"'\"message_id\":\"' || CASE WHEN event_id % 17 = 0 THEN '' ELSE 'm' || {text('event_id')} END || '\"'"
    content = "'\"content\":' || CASE event_id % 5 WHEN 0 THEN 'null' WHEN 1 THEN '7' WHEN 2 THEN '\"\"' ELSE '\"said\"' END"
    hidden = "CASE WHEN event_id % 19 = 0 THEN '\"Hidden-Tests\":[],' WHEN event_id % 23 = 0 THEN '\"a\":{\"rubric\":1},' ELSE '' END"
    body = f"""CASE kind WHEN 'session_started' THEN '{{' || {hidden} || '"initial_state_hash":"x"' || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"scenario_instance_id":"i"' END || '}}'
 WHEN 'model_response' THEN '{{' || {hidden} || {content} || ',' || {mid} || CASE WHEN event_id % 11 = 0 THEN ',"tool_calls":{{}}' WHEN event_id % 3 = 0 THEN ',"tool_calls":[' || {call} || ',' || {other} || ']' WHEN event_id % 3 = 1 THEN ',"tool_calls":[' || {call} || ']' ELSE '' END || '}}'
 WHEN 'tool_message' THEN '{{' || {hidden} || {content} || ',' || {mid} || ',"name":"t' || {text('event_id % 3')} || '","tool_call_id":"c' || {text('event_id % 7')} || '"}}'
 WHEN 'session_finished' THEN '{{"final_state_hash":"y","success":true,"termination_reason":"' || CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'tired' END || '"}}'
 WHEN 'system_message' THEN '{{' || {content} || ',' || {mid} || '}}' WHEN 'user_message' THEN '{{' || {hidden} || {content} || '}}'
 WHEN 'verification_result' THEN '{{"note":"\\"rubric\\":","passed":true,"score":1,"verifier":"v"}}' ELSE '{{"call_id":"c1","name":"t"}}' END"""
    session = f"CASE WHEN user_id % 40 = 7 THEN 's\"7' ELSE 's' || {text('user_id % 40')} END"
    odd = "event_id % 4 = 1"
    spelled = f"CASE WHEN {odd} THEN '{{ \"zé\" : [ 1 , \"\\u00fc\" ] ,' || substr(body, 2) ELSE body END"
    plain = f"CASE WHEN {odd} THEN substr(body, 1, length(body) - 1) || ',\"z\\u00e9\":[1,\"\\u00fc\"]}}' ELSE body END"
    return f"""SELECT n, session_id, sequence, event_type, schema_version, {spelled} AS payload, {plain} AS canonical FROM (SELECT event_id, event_id AS n, {session} AS session_id, CAST(row_number() OVER (PARTITION BY user_id % 40 ORDER BY event_id) - CASE WHEN event_id % 31 = 0 THEN 1000000 ELSE 1 END AS INTEGER) AS sequence,
 kind AS event_type, {body} AS body, CASE WHEN event_id % 29 = 0 THEN 1 ELSE 2 END AS schema_version FROM (SELECT *, {KIND} AS kind FROM events) k) b"""


OWN = """'{"event_type":"' || event_type || '","payload":' || canonical || ',"schema_version":' || CAST(schema_version AS VARCHAR) || ',"sequence":' || CAST(sequence AS VARCHAR) || ',"session_id":"' || replace(session_id, '"', '\\"') || '"}'"""


def _raw(sha: str, s: str) -> str:
    return f"SELECT session_id, sequence, event_type, payload, canonical, schema_version, CASE WHEN n % 2 = 0 THEN '' WHEN n % 37 = 0 THEN 'event_0' ELSE 'event_' || substr({sha}, 1, 16) END AS event_id FROM ({_payloads(s)}) p"


RAW = f"v_raw_events AS ({_raw(f'sha256({OWN})', 'VARCHAR')})"


def _events(spark, sf):
    # as a string literal, Spark reads a backslash before a quote as an escape
    text = _raw(f"sha2({OWN.replace('VARCHAR', 'STRING')}, 256)", "STRING").replace("\\", "\\\\")
    return _sql(spark, sf, ["events"], text)


NEED = "CASE event_type " + " ".join(f"WHEN '{k}' THEN [{', '.join(repr(n) for n in sorted(v))}]" for k, v in E.REQUIRED.items()) + " ELSE [] END"
TEXT = "(json_type(payload, '$.{k}') = 'VARCHAR' AND length(json_extract_string(payload, '$.{k}')) >= {n})"


def _text(k: str, n: int) -> str:
    return TEXT.replace("{k}", k).replace("{n}", str(n))


HIDDEN = f"len(list_filter(list_transform(list_filter(regexp_extract_all(payload, '\"(?:[^\"\\\\]|\\\\.)*\"(?:\\s*:)?'), lambda x: x LIKE '%:'), lambda x: replace(replace(lower(regexp_replace(x, '^\"|\"\\s*:$', '', 'g')), '-', '_'), ' ', '_')), lambda x: x IN {_list(E.HIDDEN)})) > 0"


@query(
    f"""WITH {RAW}, k AS (SELECT *, json_keys(payload) AS ks, CASE WHEN json_type(payload, '$.tool_calls') = 'ARRAY' THEN CAST(json_extract(payload, '$.tool_calls') AS JSON[]) END AS calls, json_type(payload, '$.tool_calls') AS ct, {NEED} AS need FROM v_raw_events),
 m AS (SELECT *, list_filter(need, lambda x: NOT list_contains(ks, x)) AS missing, list_filter(list_transform(calls, lambda c: json_extract_string(c, '$.id')), lambda x: x <> '') AS ids FROM k),
 x AS (SELECT session_id, sequence, unnest(list_filter([CASE WHEN schema_version <> 2 THEN 'unsupported_version' END, CASE WHEN sequence < 0 THEN 'negative_sequence' END, CASE WHEN event_type NOT IN {_list(E.REQUIRED)} THEN 'unknown_event_type' END,
 CASE WHEN {HIDDEN} THEN 'hidden_field' END, CASE WHEN len(missing) > 0 THEN 'missing:' || array_to_string(missing, ',') END,
 CASE WHEN event_type IN ('system_message', 'model_response', 'tool_message') AND list_contains(ks, 'message_id') AND NOT {_text('message_id', 1)} THEN 'message_id' END,
 CASE WHEN event_type = 'system_message' AND list_contains(ks, 'content') AND NOT coalesce({_text('content', 1)}, false) THEN 'content' WHEN event_type = 'model_response' AND list_contains(ks, 'content') AND NOT ({_text('content', 0)} OR json_type(payload, '$.content') = 'NULL') THEN 'content' WHEN event_type = 'tool_message' AND list_contains(ks, 'content') AND NOT coalesce({_text('content', 0)}, false) THEN 'content' END,
 CASE WHEN event_type = 'model_response' AND ct IS NOT NULL AND calls IS NULL THEN 'tool_calls' END, CASE WHEN event_type = 'model_response' AND len(ids) <> len(list_distinct(ids)) THEN 'repeated_call_id' END,
 CASE WHEN event_type = 'session_finished' AND json_extract_string(payload, '$.termination_reason') NOT IN {_list(E.TERMINATIONS)} THEN 'termination_reason' END,
 CASE WHEN event_id <> '' AND event_id <> 'event_' || substr(sha256({OWN}), 1, 16) THEN 'event_id' END], lambda v: v IS NOT NULL)) AS code FROM m) SELECT * FROM x"""
)
def strict_event_violations(spark, sf):
    return E.violations(_events(spark, sf))


@query(
    f"""WITH {RAW}, o AS (SELECT *, row_number() OVER s AS place, count(*) OVER (PARTITION BY session_id) AS n, sum(CASE WHEN event_type = 'system_message' THEN 1 ELSE 0 END) OVER s AS systems, sum(CASE WHEN event_type = 'session_finished' THEN 1 ELSE 0 END) OVER s AS ends FROM v_raw_events WINDOW s AS (PARTITION BY session_id ORDER BY sequence)),
 shape AS (SELECT session_id, sequence, unnest(list_filter([CASE WHEN place = 1 AND event_type <> 'session_started' THEN 'first_is_not_session_started' END, CASE WHEN event_type = 'system_message' AND systems > 1 THEN 'second_system_message' END, CASE WHEN place = 2 AND event_type <> 'system_message' THEN 'second_is_not_system_message' END,
 CASE WHEN event_type = 'session_finished' AND ends > 1 THEN 'second_session_finished' END, CASE WHEN event_type = 'session_finished' AND place <> n THEN 'session_finished_is_not_last' END], lambda v: v IS NOT NULL)) AS code FROM o),
 calls AS (SELECT session_id, sequence, unnest(list_transform(cs, lambda c, i: struct_pack(call_id := json_extract_string(c, '$.id'), name := json_extract_string(c, '$.function.name'), i := i))) AS c FROM (SELECT session_id, sequence, CAST(json_extract(payload, '$.tool_calls') AS JSON[]) AS cs FROM v_raw_events WHERE event_type = 'model_response' AND json_type(payload, '$.tool_calls') = 'ARRAY')),
 steps AS (SELECT session_id, sequence, c.call_id AS call_id, c.name AS name, 0 AS answer, c.i AS i FROM calls UNION ALL SELECT session_id, sequence, json_extract_string(payload, '$.tool_call_id'), json_extract_string(payload, '$.name'), 1, 0 FROM v_raw_events WHERE event_type = 'tool_message'),
 a AS (SELECT *, coalesce(sum(1 - answer) OVER b, 0) AS asked, first_value(CASE WHEN answer = 0 THEN name END IGNORE NULLS) OVER b AS asked_name FROM steps WINDOW b AS (PARTITION BY session_id, call_id ORDER BY sequence, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 d AS (SELECT *, coalesce(sum(CASE WHEN answer = 1 AND asked > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, call_id ORDER BY sequence, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM a),
 p AS (SELECT session_id, sequence, CASE WHEN answer = 0 AND asked > 0 THEN 'repeated_call_id' WHEN answer = 1 AND asked = 0 THEN 'tool_message_without_call' WHEN answer = 1 AND done > 0 THEN 'second_tool_message' WHEN answer = 1 AND name <> asked_name THEN 'tool_message_name' END AS code FROM d),
 ch AS (SELECT session_id, sequence, sum(CASE WHEN answer = 0 AND asked = 0 THEN 1 WHEN answer = 1 AND asked > 0 AND done = 0 THEN -1 ELSE 0 END) AS change FROM d GROUP BY 1, 2),
 w AS (SELECT session_id, sequence, event_type, coalesce(sum(coalesce(change, 0)) OVER (PARTITION BY session_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM v_raw_events LEFT JOIN ch USING (session_id, sequence))
 SELECT * FROM shape UNION ALL SELECT * FROM p WHERE code IS NOT NULL UNION ALL SELECT session_id, sequence, 'open_calls_at_' || event_type FROM w WHERE event_type IN ('model_response', 'session_finished') AND open > 0"""
)
def strict_order_violations(spark, sf):
    return E.order_violations(_events(spark, sf))


FIELD = "CASE CAST(doc_id % 7 AS INTEGER) WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '[\"' || coalesce(lang, '') || '\", 3, true, null, \" x \"]' WHEN 3 THEN coalesce(lang, '') || ', ' || coalesce(source, '') || ' ,, a' WHEN 4 THEN '[1, 2.5]' WHEN 5 THEN '  ' ELSE coalesce(source, '') END"


@query(
    f"""WITH f AS (SELECT doc_id, trim(coalesce({FIELD}, '')) AS t FROM documents), l AS (SELECT doc_id, CASE WHEN t = '' THEN CAST([] AS VARCHAR[]) WHEN t LIKE '[%' THEN list_filter(list_transform(CAST(t AS JSON[]), lambda x: CASE json_type(x) WHEN 'BOOLEAN' THEN upper(substr(CAST(x AS VARCHAR), 1, 1)) || substr(CAST(x AS VARCHAR), 2) WHEN 'NULL' THEN '' ELSE trim(x ->> '$') END), lambda x: x <> '')
 ELSE list_filter(list_transform(string_split(t, ','), lambda x: trim(x)), lambda x: x <> '') END AS v FROM f) SELECT doc_id, array_to_string(v, '|') AS listed, array_to_string(list_filter(v, lambda x, i: list_position(v, x) = i), '|') AS once FROM l"""
)
def list_fields(spark, sf):
    v = _sql(spark, sf, ["documents"], f"SELECT doc_id, {FIELD} AS f FROM documents").withColumn("v", X.list_field(F.col("f")))
    return v.select("doc_id", F.array_join("v", "|").alias("listed"), F.array_join(X.distinct_in_order(F.col("v")), "|").alias("once"))


WHEN_SPARK = "concat(date_format(ts, 'yyyy-MM-dd'), if(event_id % 2 = 0, 'T', ' '), date_format(ts, 'HH:mm:ss'), if(event_id % 3 = 0, concat('.', date_format(ts, 'SSSSSS')), ''), CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'Z' WHEN 1 THEN '+02:00' WHEN 2 THEN '-05:30' WHEN 3 THEN '' ELSE '+00:00' END)"
WHEN_DUCK = "strftime(ts, '%Y-%m-%d') || CASE WHEN event_id % 2 = 0 THEN 'T' ELSE ' ' END || strftime(ts, '%H:%M:%S') || CASE WHEN event_id % 3 = 0 THEN '.' || strftime(ts, '%f') ELSE '' END"


@query(
    f"""WITH t AS (SELECT event_id, CAST(replace(w, 'T', ' ') AS TIMESTAMP) - CASE CAST(event_id % 5 AS INTEGER) WHEN 1 THEN INTERVAL 120 MINUTE WHEN 2 THEN INTERVAL (-330) MINUTE ELSE INTERVAL 0 MINUTE END AS u FROM (SELECT event_id, {WHEN_DUCK} AS w FROM events))
 SELECT event_id, CASE WHEN event_id % 5 <> 3 THEN strftime(u, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(u, '%f') <> '000000' THEN '.' || strftime(u, '%f') ELSE '' END || 'Z' END AS canonical FROM t"""
)
def parsed_timestamps(spark, sf):
    return _sql(spark, sf, ["events"], f"SELECT event_id, {WHEN_SPARK} AS w FROM events").select("event_id", X.canonical_timestamp(F.col("w")).alias("canonical"))


SIZES = "CASE CAST(p_partkey % 6 AS INTEGER) WHEN 0 THEN CAST(p_size AS {s}) || 'm' WHEN 1 THEN ' ' || CAST(p_size AS {s}) || '.5G ' WHEN 2 THEN CAST(p_size AS {s}) WHEN 3 THEN 'xk' WHEN 4 THEN CAST(p_size AS {s}) || 'b' ELSE '' END"
IMAGES = "CASE CAST(p_partkey % 4 AS INTEGER) WHEN 0 THEN 'repo/a@sha256:1' WHEN 1 THEN 'sha256:' || repeat('aF', 32) WHEN 2 THEN 'repo/a:latest' ELSE 'sha256:12' END"


@query(
    f"""WITH x AS (SELECT p_partkey, lower(trim({SIZES.replace('{s}', 'VARCHAR')})) AS s, {IMAGES} AS image FROM part) SELECT p_partkey, coalesce(CAST(floor(TRY_CAST(substr(s, 1, greatest(length(s) - 1, 0)) AS DOUBLE) * CASE right(s, 1) WHEN 'b' THEN 1 WHEN 'k' THEN 1024 WHEN 'm' THEN 1048576 WHEN 'g' THEN 1073741824 END) AS BIGINT), -1) AS bytes,
 image LIKE '%@sha256:%' OR regexp_full_match(image, 'sha256:[0-9a-fA-F]{{64}}') AS immutable FROM x"""
)
def environment_fields(spark, sf):
    return _sql(spark, sf, ["part"], f"SELECT p_partkey, {SIZES.replace('{s}', 'STRING')} AS s, {IMAGES} AS image FROM part").select("p_partkey", X.memory_bytes(F.col("s")).alias("bytes"), X.immutable_image(F.col("image")).alias("immutable"))


SEED = """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE coalesce(source, '') || '__Repo' END AS context, 'Meta Org__x-y' AS meta, CASE WHEN doc_id % 2 = 0 THEN coalesce(lang, '') ELSE '' END AS tag, coalesce(lang, '') AS own,
 CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'SWE-Bench' END AS name, coalesce(source, '') || ':more' AS provenance, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Inst ' || CAST(doc_id AS {s}) END AS inst,
 CASE CAST(doc_id % 4 AS INTEGER) WHEN 0 THEN 'swe_smith' WHEN 1 THEN 'swe_bench' WHEN 2 THEN 'public_issue' ELSE '' END AS format, CASE WHEN doc_id % 6 = 0 THEN 'Bug Repair' ELSE '' END AS family FROM documents"""
_LABEL = "replace(replace(lower(trim({x})), '-', '_'), ' ', '_')"


def _label(x: str) -> str:
    return _LABEL.replace("{x}", x)


@query(
    f"""WITH s AS ({SEED.replace('{s}', 'VARCHAR')}) SELECT doc_id, replace({_label("CASE WHEN context <> '' THEN context ELSE meta END")}, '__', '/') AS repository, {_label("CASE WHEN doc_id % 2 = 0 THEN tag ELSE own END")} AS language,
 CASE WHEN (name = '' AND split_part(provenance, ':', 1) = '') OR inst = '' THEN '' ELSE replace({_label("CASE WHEN name <> '' THEN name ELSE split_part(provenance, ':', 1) END")}, '__', '/') || ':' || {_label('inst')} END AS instance_key,
 CASE WHEN family <> '' THEN {_label('family')} WHEN format IN ('swe_bench', 'swe_smith', 'multi_swe') THEN 'bug_repair' ELSE 'software_engineering' END AS family, CASE WHEN format = 'swe_smith' THEN 'synthetic_issue_workspace' ELSE 'external_issue_workspace' END AS method FROM s"""
)
def seed_keys(spark, sf):
    s = _sql(spark, sf, ["documents"], SEED.replace("{s}", "STRING"))
    tags = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("kind:x"), F.concat(F.lit("language:"), F.col("tag")), F.lit("language:zz"))).otherwise(F.array(F.lit("kind:x")))
    return s.select(
        "doc_id", X.seed_repository(F.col("context"), F.col("meta")).alias("repository"), X.seed_language(tags, F.col("own")).alias("language"), X.source_instance_key(F.col("name"), F.col("provenance"), F.col("inst")).alias("instance_key"),
        X.default_family(F.col("family"), F.col("format")).alias("family"), X.default_method(F.col("format")).alias("method"),
    )


@query("SELECT conv_id, turn, contains(lower(text), 'new_goal') OR contains(lower(text), 'new goal') OR contains(lower(text), 'the') AS satisfied FROM conversations")
def goal_mentions(spark, sf):
    return A.table(spark, sf, "conversations").select("conv_id", "turn", X.goal_satisfied(F.col("text"), F.lit("New_Goal"), F.lit("The")).alias("satisfied"))


@query(
    """SELECT page_id, array_to_string(list_concat(CASE WHEN page_id % 2 = 0 THEN ['hidden_test_patch'] ELSE [] END, list_transform(range(page_id % 3), lambda x: 'hidden_command'), CASE WHEN page_id % 5 = 0 THEN ['required_state'] ELSE [] END,
 CASE WHEN page_id % 7 = 0 THEN ['forbidden_state'] ELSE [] END, CASE WHEN page_id % 4 = 0 OR page_id % 6 = 0 THEN ['trace_requirements'] ELSE [] END), ',') AS evaluators FROM pages"""
)
def evaluator_order(spark, sf):
    n = F.col("page_id")

    def some(k: int):
        return F.when(n % k == 0, F.array(F.lit("x")))

    hidden = F.array_repeat(F.lit("cmd"), (n % 3).cast("int"))
    return A.table(spark, sf, "pages").select("page_id", F.array_join(X.evaluators(F.when(n % 2 == 0, "diff"), hidden, some(5), some(7), some(4), some(6)), ",").alias("evaluators"))


ALLOWED = """SELECT page_id AS position, CASE WHEN page_id % 13 = 0 THEN '' ELSE 'Org__' || CAST(page_id % 9 AS {s}) END AS repository, page_id % 10 = 0 AS benchmark_overlap,
 CASE CAST(page_id % 6 AS INTEGER) WHEN 0 THEN url WHEN 1 THEN '' WHEN 2 THEN 'https://localhost/x' WHEN 3 THEN 'file:///x' WHEN 4 THEN 'https://user@git.example.org:8443/r.git' ELSE 'http://git.example.org/r' END AS source_uri,
 CASE CAST(page_id % 5 AS INTEGER) WHEN 0 THEN 'Apache 2.0' WHEN 1 THEN '0BSD' WHEN 2 THEN 'GPL-3.0' WHEN 3 THEN ' ' ELSE 'Python-2.0' END AS license, CASE WHEN page_id % 8 = 0 THEN NULL ELSE 'python' END AS language, page_id % 4 = 0 AS no_source, page_id % 7 = 0 AS no_test, page_id % 3 = 0 AS no_ci FROM pages"""


@query(
    f"""WITH a AS ({ALLOWED.replace('{s}', 'VARCHAR')}), h AS (SELECT *, replace({_label('repository')}, '__', '/') AS r, {_label("coalesce(license, '')")} AS l, lower(regexp_extract(source_uri, '^https://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host FROM a)
 SELECT position, r AS repository, unnest(list_filter([CASE WHEN r = '' THEN 'missing_repository' END, CASE WHEN r = 'org/3' OR benchmark_overlap THEN 'benchmark_overlap' END,
 CASE WHEN source_uri = '' THEN 'missing_source_uri' WHEN NOT (source_uri LIKE 'file:%' OR (source_uri LIKE 'https://%' AND contains(host, '.') AND host <> '127.0.0.1')) THEN 'non_public_source_uri' END,
 CASE WHEN l = '' THEN 'missing_license' WHEN l NOT IN {_list(R.LICENSES)} THEN 'license_not_allowlisted' END, CASE WHEN coalesce(language, '') = '' THEN 'missing_language' END, CASE WHEN no_source THEN 'missing_collection_source' END,
 CASE WHEN no_test AND no_ci THEN 'missing_stable_command' END], lambda v: v IS NOT NULL)) AS code FROM h"""
)
def allowlist_issues(spark, sf):
    a = _sql(spark, sf, ["pages"], ALLOWED.replace("{s}", "STRING"))

    def listed(flag: str):
        return F.when(~F.col(flag), F.array(F.lit("x"))).otherwise(F.array(F.lit(" ")))

    a = a.withColumns({"collection_sources": listed("no_source"), "test_commands": listed("no_test"), "ci_commands": listed("no_ci")})
    return R.allowlist_issues(a, ("org/3",))


USAGE = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE CAST(l_partkey % 8 AS INTEGER) WHEN 0 THEN '{{"prompt_tokens":' || p || ',"completion_tokens":' || c || ',"prompt_tokens_details":{{"cached_tokens":' || k || '}}}}'
 WHEN 1 THEN '{{"prompt_cache_hit_tokens":' || k || ',"prompt_cache_miss_tokens":' || p || ',"output_tokens":' || c || '}}' WHEN 2 THEN '{{"prompt_tokens":' || p || ',"completion_tokens":' || c || ',"total_tokens":' || t || '}}'
 WHEN 3 THEN '{{"input_tokens":' || p || ',"prompt_tokens":' || c || ',"output_tokens":' || c || '}}' WHEN 4 THEN '{{"completion_tokens":' || c || '}}' WHEN 5 THEN '{{"input_tokens":' || p || '}}'
 WHEN 6 THEN '{{"input_tokens":' || p || ',"output_tokens":"' || c || '"}}' ELSE '{{}}' END AS usage, CAST(p AS BIGINT) AS p, CAST(c AS BIGINT) AS c, CAST(k AS BIGINT) AS k
 FROM (SELECT *, CAST(CAST(l_quantity * 100 AS BIGINT) AS {s}) AS p, CAST(CAST(round(l_tax * 1000) AS BIGINT) AS {s}) AS c, CAST(CAST(round(l_discount * 1000) AS BIGINT) AS {s}) AS k, CAST(CAST(l_quantity * 100 AS BIGINT) + CAST(round(l_tax * 1000) AS BIGINT) + l_suppkey % 2 AS {s}) AS t FROM lineitem) q"""


@query(
    f"""WITH u AS ({USAGE.format(s='VARCHAR')}), e AS (SELECT *, CAST(l_partkey % 8 AS INTEGER) AS m FROM u), x AS (SELECT *, CASE WHEN m = 7 THEN 'empty' WHEN m = 6 THEN 'not_a_count' WHEN m = 3 AND p <> c THEN 'input_conflict' WHEN m = 4 THEN 'input_missing' WHEN m = 0 AND k > p THEN 'cached_above_input' WHEN m = 5 THEN 'output_missing'
 WHEN m = 2 AND l_suppkey % 2 = 1 THEN 'total' ELSE '' END AS error, CASE m WHEN 1 THEN p + k ELSE p END AS i, CASE WHEN m IN (0, 1) THEN k ELSE 0 END AS h FROM e)
 SELECT l_orderkey, l_linenumber, l_partkey, error, CASE WHEN error = '' THEN i END AS input_tokens, CASE WHEN error = '' THEN h END AS cached_tokens, CASE WHEN error = '' THEN c END AS output_tokens, CASE WHEN error = '' THEN CAST(CAST((i - h) * 300 + h * 30 + c * 1500 AS DECIMAL(28, 8)) / 100000000 AS DOUBLE) END AS cost_usd FROM x"""
)
def priced_usage(spark, sf):
    u = _sql(spark, sf, ["lineitem"], USAGE.format(s="STRING"))
    return U.priced(u, "usage", "3", "0.3", "15").select("l_orderkey", "l_linenumber", "l_partkey", "error", "input_tokens", "cached_tokens", "output_tokens", F.col("cost_usd").cast("double").alias("cost_usd"))


ELIGIBLE = """WITH r AS (SELECT l_orderkey AS job_id, CASE CAST(l_partkey % 4 AS INTEGER) WHEN 0 THEN 'hidden_command' WHEN 1 THEN 'required_state' ELSE 'agent_termination' END AS verifier, l_quantity > 5 AS passed, l_returnflag = 'R' AND l_quantity > 45 AS infra, l_discount AS score FROM lineitem),
 g AS (SELECT job_id, bool_and(passed) AS passed, bool_or(infra) AS infra, count(*) FILTER (verifier <> 'agent_termination') AS hard, coalesce(bool_and(score > 0) FILTER (verifier <> 'agent_termination'), false) AS scored FROM r GROUP BY 1)
 SELECT job_id, CASE WHEN infra THEN 'infrastructure_failure' WHEN NOT passed THEN 'not_successful' WHEN hard = 0 OR NOT scored THEN 'no_hard_verifier' WHEN o_orderstatus IS NULL OR o_orderstatus <> 'F' THEN 'not_finished_as_successful' ELSE '' END AS reason FROM g LEFT JOIN orders ON o_orderkey = job_id"""


def _eligible(spark, sf):
    kind = F.when(F.col("l_partkey") % 4 == 0, "hidden_command").when(F.col("l_partkey") % 4 == 1, "required_state").otherwise("agent_termination")
    results = A.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_id"), kind.alias("verifier"), (F.col("l_quantity") > 5).alias("passed"), ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).alias("infra"), F.col("l_discount").alias("score"))
    return T.sft_eligibility(results, A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), (F.col("o_orderstatus") == "F").alias("success")))


@query(ELIGIBLE)
def sft_eligibility(spark, sf):
    return _eligible(spark, sf)


@query(
    f"""WITH {A.MESSAGES}, e AS (SELECT 's' || CAST(job_id AS VARCHAR) AS session_id FROM ({ELIGIBLE}) WHERE reason = '') SELECT session_id, count(*) AS messages, sha256(string_agg(role || ':' || content, chr(10) ORDER BY sequence)) AS messages_sha256
 FROM v_msgs WHERE session_id IN (SELECT session_id FROM e) GROUP BY session_id HAVING arg_max(role, sequence) = 'assistant' AND length(trim(arg_max(content, sequence))) > 0"""
)
def sft_export(spark, sf):
    fit = _eligible(spark, sf).where("reason = ''").select(F.concat(F.lit("s"), F.col("job_id").cast("string")).alias("session_id"))
    return T.sft(A.messages(spark, sf), fit)


@query("SELECT CAST(sum(CASE WHEN doc_id % 4 < 3 THEN n_chars ELSE 1 END) AS BIGINT) AS records, CAST(sum(CASE WHEN doc_id % 4 = 1 THEN 0 ELSE doc_id % 3 END) AS BIGINT) AS issues FROM documents")
def quarantine_summary(spark, sf):
    d = A.table(spark, sf, "documents")
    issues = F.when(F.col("doc_id") % 4 != 1, F.array_repeat(F.lit("i"), (F.col("doc_id") % 3).cast("int"))).alias("issues")
    sides = [d.where(F.col("doc_id") % 4 == k).select(F.col("n_chars").alias("skipped"), issues) for k in range(3)]
    return R.quarantined(*sides, d.where(F.col("doc_id") % 4 == 3).select(F.lit(1).alias("quarantined"), issues))


@query(
    """WITH r AS (SELECT o_orderdate AS summary, o_orderkey AS position, 'scenario_' || CAST(o_custkey AS VARCHAR) AS scenario_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'inst_' || CAST(o_custkey % 50 AS VARCHAR) END AS inst FROM orders WHERE o_orderstatus <> 'F'),
 m AS (SELECT coalesce(inst, CASE WHEN c_acctbal > 0 THEN 'inst_' || CAST(c_nationkey AS VARCHAR) END) AS id, * FROM r LEFT JOIN customer ON scenario_id = 'scenario_' || CAST(c_custkey AS VARCHAR))
 SELECT id AS source_instance_id, arg_max(scenario_id, position) AS scenario_id, arg_max(position, position) AS summary FROM m WHERE id IS NOT NULL GROUP BY id"""
)
def failure_evidence(spark, sf):
    results = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("summary"), F.lit(0).alias("position"), F.concat(F.lit("scenario_"), F.col("o_custkey").cast("string")).alias("scenario_id"), F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("inst_"), (F.col("o_custkey") % 50).cast("string"))).alias("source_instance_id"), (F.col("o_orderstatus") == "F").alias("valid"))
    scenarios = A.table(spark, sf, "customer").select(F.concat(F.lit("scenario_"), F.col("c_custkey").cast("string")).alias("scenario_id"), F.when(F.col("c_acctbal") > 0, F.concat(F.lit("inst_"), F.col("c_nationkey").cast("string"))).otherwise("").alias("source_instance_id"))
    return R.failure_evidence(results, scenarios)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def selected_rows(spark, sf):
    li = A.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return R.selected_ids(A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", li.where("l_returnflag = 'R'"), li.where("l_quantity > 40"))
