"""Queries over replayed sessions, training episodes, policy decisions and exported views."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.operators import exports as X
from trajlake.operators import policy as P
from trajlake.operators import replay as R
from trajlake.operators import source_records as S
from trajlake.operators import usage as U
from trajlake.operators.events import REQUIRED
from trajlake.plans import adapters as A
from trajlake.plans.registry import query
from trajlake.plans.release_queries import T
from trajlake.plans.strict_queries import _sql

_kind = "CASE CAST(event_id % 12 AS INTEGER) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(REQUIRED)) + " END"
_call = "\"call_id\":\"c' || CAST(event_id % 7 AS {s}) || '\""
#: Events of sessions with payloads of all kinds; ``{s}`` is the text type.
EVENTS = (
    """SELECT 's' || CAST(user_id % 60 AS {s}) AS session_id, CAST(row_number() OVER (PARTITION BY user_id % 60 ORDER BY event_id) AS INTEGER) AS sequence, 'e' || CAST(event_id AS {s}) AS event_id, kind AS event_type,
 CASE kind WHEN 'session_started' THEN '{"scenario_instance_id":"i' || CAST(event_id % 5 AS {s}) || '","initial_state_hash":"h' || CAST(event_id % 2 AS {s}) || '"}'
 WHEN 'model_response' THEN '{"message_id":"m' || CAST(event_id % 500 AS {s}) || '","content":' || CASE WHEN event_id % 5 = 0 THEN 'null' WHEN event_id % 5 = 1 THEN '"please confirm"' WHEN event_id % 5 = 2 THEN '"  "' ELSE '"done"' END || CASE WHEN event_id % 8 = 3 THEN ',"tool_calls":[{"id":"c1","function":{"name":"ask_user"}}]' WHEN event_id % 16 = 7 THEN ',"tool_calls":[{"id":"c1","function":{"name":"ask_user"}},{"id":"c2","function":{"name":"t"}}]' ELSE '' END || CASE WHEN event_id % 9 = 0 THEN ',"reasoning_content":"why"' ELSE '' END || '}'
 WHEN 'tool_requested' THEN '{@,"name":"t' || CAST(event_id % 3 AS {s}) || '","arguments":{"n":' || CAST(event_id % 10 AS {s}) || '}}'
 WHEN 'policy_decision' THEN '{@,"decision":"' || CASE WHEN event_id % 5 = 0 THEN 'deny' ELSE 'allow' END || '","reason":"r' || CAST(event_id % 4 AS {s}) || '"}' WHEN 'tool_started' THEN '{@,"name":"t9"}'
 WHEN 'tool_finished' THEN '{@,"status":"' || CASE WHEN event_id % 5 = 0 THEN 'failed' ELSE 'completed' END || '","exit_code":' || CASE WHEN event_id % 5 = 1 THEN 'null' ELSE CAST(event_id % 5 AS {s}) END || CASE WHEN event_id % 5 = 0 THEN ',"error":"bad"' ELSE ',"output":"out"' END || '}'
 WHEN 'tool_message' THEN '{"message_id":"m' || CAST(event_id % 500 AS {s}) || '","name":"t8","tool_call_id":"c' || CAST(event_id % 7 AS {s}) || '","content":"back"}' WHEN 'workspace_diff' THEN '{"before_state_hash":"h' || CAST(event_id % 2 AS {s}) || '","after_state_hash":"h' || CAST(event_id % 3 AS {s}) || '"}'
 WHEN 'verification_result' THEN '{"verifier":"v","passed":' || CASE WHEN event_id % 5 < 3 THEN 'true' ELSE 'false' END || ',"score":1}' WHEN 'session_finished' THEN '{"termination_reason":"' || CASE WHEN event_id % 5 = 0 THEN 'timeout' ELSE 'success' END || '","final_state_hash":"h' || CAST(event_id % 3 AS {s}) || '","success":' || CASE WHEN event_id % 5 = 0 THEN 'false' ELSE 'true' END || '}'
 ELSE '{"message_id":"' || CASE WHEN event_id % 11 = 0 THEN '' ELSE 'm' || CAST(event_id % 500 AS {s}) END || '","content":"said"}' END AS payload FROM (SELECT *, """.replace("@", _call)
    + _kind
    + " AS kind FROM events) k"
)
V_EVENTS = f"v_events AS ({EVENTS.replace('{s}', 'VARCHAR')})"


def _events(spark, sf):
    return _sql(spark, sf, ["events"], EVENTS.replace("{s}", "STRING"))


def _j(field: str) -> str:
    return f"json_extract_string(payload, '$.{field}')"


MESSAGE = "event_type IN ('system_message', 'user_message', 'model_response', 'tool_message')"
ROLE = "CASE event_type WHEN 'system_message' THEN 'system' WHEN 'user_message' THEN 'user' WHEN 'model_response' THEN 'assistant' WHEN 'tool_message' THEN 'tool' END"
N_CALLS = "coalesce(CAST(json_array_length(payload, '$.tool_calls') AS INTEGER), 0)"


@query(
    f"""WITH {V_EVENTS} SELECT session_id, CAST(row_number() OVER (PARTITION BY session_id ORDER BY sequence) - 1 AS INTEGER) AS position, {_j('message_id')} AS message_id, {ROLE} AS role, {_j('content')} AS content, CASE WHEN event_type = 'tool_message' THEN {_j('name')} END AS name, CASE WHEN event_type = 'tool_message' THEN {_j('tool_call_id')} END AS tool_call_id,
 CASE WHEN event_type = 'model_response' THEN {N_CALLS} END AS calls, CASE WHEN event_type = 'model_response' THEN {_j('reasoning_content')} END AS reasoning FROM v_events WHERE {MESSAGE}"""
)
def replay_messages(spark, sf):
    return R.messages(_events(spark, sf))


@query(
    f"""WITH {V_EVENTS}, c AS (SELECT *, CASE WHEN event_type = 'tool_message' THEN {_j('tool_call_id')} ELSE {_j('call_id')} END AS call_id FROM v_events WHERE event_type IN ('tool_requested', 'policy_decision', 'tool_started', 'tool_finished', 'tool_message'))
 SELECT session_id, call_id, coalesce(arg_max({_j('name')}, sequence) FILTER (event_type = 'tool_requested'), arg_min({_j('name')}, sequence) FILTER (event_type IN ('tool_started', 'tool_message'))) AS name, arg_max(CAST(json_extract(payload, '$.arguments') AS VARCHAR), sequence) FILTER (event_type = 'tool_requested') AS arguments,
 arg_max(CASE event_type WHEN 'tool_requested' THEN 'requested' WHEN 'tool_started' THEN 'started' ELSE {_j('status')} END, sequence) FILTER (event_type IN ('tool_requested', 'tool_started', 'tool_finished')) AS status, arg_max({_j('decision')}, sequence) FILTER (event_type = 'policy_decision') AS decision, arg_max({_j('reason')}, sequence) FILTER (event_type = 'policy_decision') AS reason,
 arg_max(coalesce({_j('exit_code')}, 'none'), sequence) FILTER (event_type = 'tool_finished') AS exit_code, arg_max(coalesce({_j('error')}, 'none'), sequence) FILTER (event_type = 'tool_finished') AS error, arg_max({_j('message_id')}, sequence) FILTER (event_type = 'tool_message') AS message_id, arg_max({_j('content')}, sequence) FILTER (event_type = 'tool_message') AS content FROM c GROUP BY 1, 2"""
)
def replay_tool_calls(spark, sf):
    calls = R.tool_calls(_events(spark, sf))
    ended = F.col("status").isin("completed", "failed") | F.col("exit_code").isNotNull() | F.col("error").isNotNull()
    finished = _events(spark, sf).where("event_type = 'tool_finished'").select("session_id", F.get_json_object("payload", "$.call_id").alias("call_id")).distinct().withColumn("_f", F.lit(True))
    out = calls.join(finished, ["session_id", "call_id"], "left")
    shown = {c: F.when(ended | F.col("_f"), F.coalesce(F.col(c).cast("string"), F.lit("none"))) for c in ("exit_code", "error")}
    return out.withColumns(shown).drop("_f")


@query(
    f"""WITH {V_EVENTS}, x AS (SELECT *, CASE WHEN event_type = 'tool_message' THEN {_j('tool_call_id')} WHEN event_type IN ('tool_requested', 'policy_decision', 'tool_started', 'tool_finished') THEN {_j('call_id')} END AS call_id, CASE event_type WHEN 'session_started' THEN {_j('initial_state_hash')} WHEN 'workspace_diff' THEN {_j('after_state_hash')} WHEN 'session_finished' THEN {_j('final_state_hash')} END AS state FROM v_events)
 SELECT session_id, arg_max({_j('scenario_instance_id')}, sequence) FILTER (event_type = 'session_started') AS scenario_instance_id, arg_max(state, sequence) FILTER (state IS NOT NULL) AS workspace_state_hash, arg_max({_j('termination_reason')}, sequence) FILTER (event_type = 'session_finished') AS termination_reason, arg_max(CAST({_j('success')} AS BOOLEAN), sequence) FILTER (event_type = 'session_finished') AS success,
 count(*) AS events, count(*) FILTER ({MESSAGE}) AS messages, count(DISTINCT call_id) AS tool_calls, count(*) FILTER (event_type = 'policy_decision') AS decisions, count(*) FILTER (event_type = 'policy_decision' AND {_j('decision')} <> 'allow') AS denied, count(*) FILTER (event_type = 'verification_result') AS verifications, count(*) FILTER (event_type = 'verification_result' AND {_j('passed')} = 'true') AS passed FROM x GROUP BY 1"""
)
def replay_sessions(spark, sf):
    return R.sessions(_events(spark, sf))


@query(
    f"""WITH {V_EVENTS}, m AS (SELECT session_id, sequence, {_j('message_id')} AS id FROM v_events WHERE {MESSAGE}), n AS (SELECT *, count(*) OVER (PARTITION BY session_id, id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM m),
 s AS (SELECT session_id, sequence, event_type, CASE event_type WHEN 'session_started' THEN {_j('initial_state_hash')} WHEN 'workspace_diff' THEN {_j('after_state_hash')} ELSE {_j('final_state_hash')} END AS state, CASE event_type WHEN 'workspace_diff' THEN {_j('before_state_hash')} WHEN 'session_finished' THEN {_j('final_state_hash')} END AS met FROM v_events WHERE event_type IN ('session_started', 'workspace_diff', 'session_finished')),
 k AS (SELECT *, lag(state) OVER (PARTITION BY session_id ORDER BY sequence) AS known FROM s) SELECT session_id, sequence, CASE WHEN id = '' THEN 'message_id' ELSE 'repeated_message_id' END AS code FROM n WHERE id = '' OR before > 0 UNION ALL SELECT session_id, sequence, event_type || '_state' FROM k WHERE event_type <> 'session_started' AND known <> met"""
)
def replay_violations(spark, sf):
    return R.replay_violations(_events(spark, sf))


@query(
    f"""WITH {V_EVENTS}, t AS (SELECT *, CAST(substr(event_id, 2) AS BIGINT) AS n, row_number() OVER (PARTITION BY session_id ORDER BY sequence) - 1 AS step, coalesce(max(CASE WHEN event_type = 'model_response' THEN sequence END) OVER (PARTITION BY session_id), max(sequence) OVER (PARTITION BY session_id)) AS target FROM v_events WHERE {MESSAGE} OR event_type IN ('tool_requested', 'tool_finished')),
 r AS (SELECT *, CASE WHEN n % 3 = 0 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS turn, CASE WHEN sequence = target AND CAST(substr(session_id, 2) AS BIGINT) % 4 <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS outcome FROM t)
 SELECT session_id, CAST(step AS INTEGER) AS step, event_id, CASE event_type WHEN 'tool_requested' THEN 'assistant' WHEN 'tool_finished' THEN 'environment' ELSE {ROLE} END AS role, CASE event_type WHEN 'system_message' THEN 'instruction' WHEN 'model_response' THEN 'action' WHEN 'tool_requested' THEN 'action_metadata' WHEN 'tool_finished' THEN 'execution_result' ELSE 'observation' END AS step_type,
 CASE event_type WHEN 'tool_requested' THEN {_j('name')} WHEN 'model_response' THEN CASE WHEN {N_CALLS} = 1 THEN 'ask_user' WHEN {N_CALLS} > 1 THEN 'tool_call' WHEN n % 5 = 1 THEN 'confirm' WHEN n % 5 IN (3, 4) THEN 'answer' ELSE 'stop' END END AS action_type, CASE event_type WHEN 'tool_finished' THEN {_j('output')} WHEN 'tool_requested' THEN NULL ELSE {_j('content')} END AS content,
 CASE event_type WHEN 'tool_message' THEN {_j('tool_call_id')} WHEN 'tool_requested' THEN {_j('call_id')} WHEN 'tool_finished' THEN {_j('call_id')} END AS call_id, CASE WHEN event_type IN ('tool_message', 'tool_requested') THEN {_j('name')} END AS name, CASE WHEN event_type = 'model_response' THEN 1 ELSE 0 END AS loss_mask, CASE WHEN event_type = 'model_response' THEN 1 ELSE 0 END AS action_mask, turn, outcome, turn + outcome AS reward FROM r"""
)
def episode_steps(spark, sf):
    e = _events(spark, sf)
    n = F.substring("event_id", 2, 20).cast("long")
    rewards = e.where(n % 3 == 0).select("event_id", F.lit(0.25).alias("reward"))
    outcomes = e.select("session_id").distinct().where(F.substring("session_id", 2, 20).cast("long") % 4 != 0).withColumn("reward", F.lit(1))
    return R.episode_steps(e, rewards, outcomes)


#: Calls with arguments that break one rule or another, and what must become of them.
_ARGS = [
    ("read_file", '{"path":"src/a.py"}', "allowed"), ("read_file", '{"path":"../b"}', "forbidden_host_path"), ("delete", "{}", "tool_not_enabled"), ("read_file", '{"\\\\u002fetc\\\\u002f":1}', "forbidden_host_path"), ("run_command", '{"command":["curl","x"]}', "network_disabled"), ("run_command", '{"command":["pip","-q","install","x"]}', "package_installation"),
    ("run_command", '{"command":["pip","install","--no-deps","x"]}', "allowed"), ("run_command", '{"command":["python3","-m","pip","install","x"]}', "package_installation"), ("run_command", '{"command":["python3","-m","pip","install","--no-index","x"]}', "allowed"), ("run_command", '{"command":["yarn","add","x"]}', "package_installation"), ("run_command", '{"command":["npm","test"]}', "allowed"),
    ("run_command", '{"command":["apk","info"]}', "package_installation"), ("run_command", '{"command":"pip install x"}', "allowed"), ("read_file", '{"command":["wget","http://x"]}', "allowed"), ("run_command", "no json", "allowed"), ("read_file", '{"a":[{"b":"/var/run/docker.sock"}]}', "forbidden_host_path"),
]


def _of_event(values: list[str]) -> str:
    return f"CASE CAST(event_id % {len(_ARGS)} AS INTEGER) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


@query(f"SELECT event_id, CASE WHEN reason = 'allowed' THEN 'allow' ELSE 'deny' END AS decision, reason FROM (SELECT event_id, {_of_event([a[2] for a in _ARGS])} AS reason FROM events)")
def policy_decisions(spark, sf):
    calls = _sql(spark, sf, ["events"], f"SELECT event_id, {_of_event([a[0] for a in _ARGS])} AS tool, {_of_event([a[1] for a in _ARGS])} AS arguments FROM events")
    return P.decisions(calls, ("read_file", "run_command"))


_runs = T["runs"].replace("CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE o_orderkey END", "o_orderkey")
RUNS = "SELECT trace_id, scenario_id, reward, success, infrastructure_failure, 'a ' || trace_id AS analysis, 'r ' || trace_id || ' ' || CAST(reward AS {s}) AS rl, 's ' || trace_id AS sft FROM (" + _runs + ") q"
_v = {"runs": RUNS, "q": T["export_quarantine"], "again": T["reproductions"]}
RECORDS = (
    ", ".join(f"{k} AS ({t.format(s='VARCHAR')})" for k, t in _v.items())
    + """, f AS (SELECT r.*, r.trace_id IN (SELECT trace_id FROM q) AS out, coalesce(g.ok, false) AS ok FROM runs r LEFT JOIN (SELECT trace_id, bool_and(coalesce(reproduced, false)) AS ok FROM again GROUP BY 1) g USING (trace_id)),
 p AS (SELECT scenario_id, count(*) AS n, count(*) FILTER (NOT out AND NOT infrastructure_failure) AS fine, max({'r': reward, 't': trace_id}) FILTER (NOT out AND NOT infrastructure_failure) AS best, min({'r': reward, 't': trace_id}) FILTER (NOT out AND NOT infrastructure_failure) AS worst FROM f GROUP BY 1),
 v_records AS (SELECT 'analysis' AS view, trace_id AS record_id, analysis AS line FROM f UNION ALL SELECT 'rl', trace_id, rl FROM f WHERE NOT out AND NOT infrastructure_failure UNION ALL SELECT 'sft', trace_id, sft FROM f WHERE NOT out AND NOT infrastructure_failure AND success AND ok
 UNION ALL SELECT 'preference', 'preference_' || best.t || '_' || worst.t, '{"chosen_trace_id":"' || best.t || '","id":"preference_' || best.t || '_' || worst.t || '","margin":' || (best.r - worst.r) || ',"rejected_trace_id":"' || worst.t || '","scenario_id":"' || scenario_id || '"}' FROM p WHERE n = 2 AND fine = 2 AND best.r > worst.r)"""
)


def _exported(spark, sf):
    return [_sql(spark, sf, ["orders"], t.format(s="STRING")) for t in _v.values()]


@query(f"WITH {RECORDS} SELECT * FROM v_records")
def export_records(spark, sf):
    return X.export_records(*_exported(spark, sf))


@query(
    f"""WITH {RECORDS}, s AS (SELECT CASE WHEN out THEN 'quarantined' WHEN infrastructure_failure THEN 'infrastructure_failure' WHEN success AND NOT ok THEN 'success_not_reproduced' END AS reason FROM f UNION ALL SELECT CASE WHEN n <> 2 THEN 'preference_not_two_runs' WHEN fine <> 2 THEN 'preference_ineligible' WHEN best.r <= worst.r THEN 'preference_tie' END FROM p)
 SELECT reason, count(*) AS n FROM s WHERE reason IS NOT NULL GROUP BY 1"""
)
def export_skip_reasons(spark, sf):
    return X.export_skips(*_exported(spark, sf))


MANIFEST = f"{RECORDS}, v_manifest AS (SELECT view, count(*) AS records, sha256(string_agg(line || chr(10), '' ORDER BY record_id)) AS sha256 FROM v_records GROUP BY 1)"


@query(f"WITH {MANIFEST} SELECT * FROM v_manifest")
def export_manifest(spark, sf):
    return X.manifest(X.export_records(*_exported(spark, sf)))


@query("SELECT 'analysis' AS view, 'records' AS code UNION ALL SELECT 'analysis', 'sha256' UNION ALL SELECT 'preference', 'missing' UNION ALL SELECT 'other', 'unexpected'")
def export_manifest_differences(spark, sf):
    right = X.manifest(X.export_records(*_exported(spark, sf)))
    declared = right.where("view <> 'preference'").withColumn("records", F.col("records") + (F.col("view") == "analysis").cast("int")).withColumn("sha256", F.when(F.col("view") == "analysis", "x").otherwise(F.col("sha256")))
    odd = A.table(spark, sf, "region").where("r_regionkey = 0").select(F.lit("other").alias("view"), F.lit(1).cast("long").alias("records"), F.lit("y").alias("sha256"))
    return X.manifest_differences(declared.unionByName(odd), right)


#: Source records of pages as JSON, with fields under other names, blank ones and wrong ones here and there.
SOURCE = """SELECT page_id AS position, CASE WHEN page_id % 97 = 5 THEN 'no json' ELSE '{' || CASE CAST(page_id % 5 AS INTEGER) WHEN 0 THEN '"repository":"Org/A/"' WHEN 1 THEN '"owner":"o","name":"n"' WHEN 2 THEN '"full_name":"f/n"' WHEN 3 THEN '"repository":" "' ELSE '"repo":["x"]' END
 || CASE WHEN page_id % 7 = 0 THEN '' ELSE ',"title":"T"' END || CASE WHEN page_id % 11 = 0 THEN ',"body":" "' ELSE ',"body":"b"' END || CASE CAST(page_id % 4 AS INTEGER) WHEN 0 THEN ',"labels":["", "x"]' WHEN 1 THEN ',"labels":[""]' WHEN 2 THEN ',"labels":"bug"' ELSE '' END || ',"license":"MIT"' || CASE WHEN page_id % 13 = 0 THEN '' ELSE ',"language":"go"' END
 || CASE CAST(page_id % 6 AS INTEGER) WHEN 0 THEN ',"source_instance_id":"i"' WHEN 1 THEN ',"number":' || CAST(page_id AS {s}) ELSE '' END || CASE CAST(page_id % 3 AS INTEGER) WHEN 0 THEN ',"ci_commands":["run"]' WHEN 1 THEN ',"required_state":{}' ELSE ',"required_state":{"a":1}' END
 || CASE CAST(page_id % 8 AS INTEGER) WHEN 0 THEN ',"source_url":"https://github.com/a/b"' WHEN 1 THEN ',"html_url":"https://Host.org/x"' WHEN 2 THEN ',"source_url":"http://github.com/c"' WHEN 3 THEN ',"url":"https://localhost/x"' WHEN 4 THEN ',"source_url":"ftp://a.b/"' WHEN 5 THEN ',"source_url":"https://github.com/a/b"' ELSE '' END
 || CASE CAST(page_id % 9 AS INTEGER) WHEN 0 THEN ',"source_revision":"short"' WHEN 1 THEN '' ELSE ',"source_revision":"' || repeat('aB', 20) || '"' END || CASE CAST(page_id % 10 AS INTEGER) WHEN 0 THEN ',"source_type":"PRs"' WHEN 1 THEN ',"type":"workflow-run"' WHEN 2 THEN '' ELSE ',"source_type":"issue"' END
 || CASE WHEN page_id % 17 = 0 THEN ',"metadata":{"dataset":"SWE-Bench Lite"}' WHEN page_id % 17 = 1 THEN ',"contamination_tags":["x","multi swe_bench"]' ELSE '' END || CASE WHEN page_id % 19 = 0 THEN ',"FAIL_TO_PASS":null' ELSE '' END || CASE WHEN page_id % 23 = 0 THEN ',"notes":[{"at":"see GIT@host:x"}]' ELSE '' END || '}' END AS raw FROM pages"""
_p = "(page_id % 97 = 5)"
_FAILS = {
    "missing_repository": "page_id % 5 IN (3, 4)", "missing_title": "page_id % 7 = 0", "missing_body": "page_id % 11 = 0", "missing_labels": "page_id % 4 IN (1, 3)", "missing_license": "false", "missing_language": "page_id % 13 = 0", "missing_source_instance_id": "NOT (page_id % 6 = 0 OR (page_id % 6 = 1 AND page_id % 5 IN (0, 1, 2)) OR page_id % 8 < 6)",
    "missing_candidate_verifier": "page_id % 3 = 1", "missing_source_url": "page_id % 8 > 5", "missing_fixed_revision": "page_id % 9 < 2", "non_public_source_url": "NOT {p} AND page_id % 8 IN (3, 4)", "private_url": "NOT {p} AND (page_id % 8 = 3 OR page_id % 23 = 0)",
}
_id = "CASE WHEN {p} THEN '' WHEN page_id % 6 = 0 THEN 'i' WHEN page_id % 6 = 1 AND page_id % 5 IN (0, 1, 2) THEN CASE CAST(page_id % 5 AS INTEGER) WHEN 0 THEN 'org__a' WHEN 1 THEN 'o__n' ELSE 'f__n' END || CASE WHEN page_id % 10 = 0 THEN '-pr-' WHEN page_id % 10 = 1 THEN '-ci-' ELSE '-issue-' END || page_id ELSE CASE CAST(page_id % 8 AS INTEGER) WHEN 1 THEN 'https://Host.org/x' WHEN 2 THEN 'http://github.com/c' WHEN 3 THEN 'https://localhost/x' WHEN 4 THEN 'ftp://a.b/' WHEN 6 THEN '' WHEN 7 THEN '' ELSE 'https://github.com/a/b' END END"


def _source(spark, sf):
    return _sql(spark, sf, ["pages"], SOURCE.replace("{s}", "STRING"))


@query(
    "SELECT page_id AS position, " + _id.replace("{p}", _p) + " AS source_instance_id, unnest(list_filter([" + ", ".join(f"CASE WHEN {_p if not w.startswith('NOT {p}') else 'false'} OR ({w.replace('{p}', _p)}) THEN '{c}' END" for c, w in _FAILS.items()) + "], lambda x: x IS NOT NULL)) AS code FROM pages"
)
def source_record_issues(spark, sf):
    return S.record_issues(_source(spark, sf))


@query(
    f"""SELECT page_id AS position, CASE WHEN {_p} OR page_id % 10 IN (1, 2) THEN 'unsupported_source_type' WHEN page_id % 5 <> 0 OR page_id % 7 = 0 OR page_id % 6 <> 0 OR page_id % 8 IN (1, 3, 6, 7) OR page_id % 9 = 1 THEN 'missing_required_public_source_fields' WHEN page_id % 9 = 0 THEN 'invalid_source_revision'
 WHEN page_id % 17 IN (0, 1) THEN 'benchmark_source_rejected' WHEN page_id % 19 = 0 THEN 'oracle_fields_rejected' WHEN page_id % 8 = 4 THEN 'other_source_url' ELSE '' END AS rejection_code FROM pages"""
)
def curation_rejections(spark, sf):
    return S.rejections(_source(spark, sf))


USAGE = """SELECT l_orderkey, CASE CAST(l_partkey % 9 AS INTEGER) WHEN 0 THEN '{"in":' || CAST(l_linenumber AS {s}) || ',"d":{"x":{"y":2},"z":1}}' WHEN 1 THEN '{"in":3,"out":-1}' WHEN 2 THEN '{"in":1.5,"out":2}' WHEN 3 THEN '{"d":7}' WHEN 4 THEN '{}' WHEN 5 THEN 'no json' WHEN 6 THEN '{"d":{"x":{"y":5}},"out":true}' WHEN 7 THEN '{"in":4,"e":{}}' ELSE '{"out":6}' END AS usage FROM lineitem"""
_flat = """v_flat AS (SELECT l_orderkey AS key, p AS path, k, CASE WHEN p = 'in' AND m = 0 THEN l_linenumber ELSE v END AS v FROM (SELECT *, CAST(l_partkey % 9 AS INTEGER) AS mm FROM lineitem) JOIN (VALUES (0, 'in', 'n', 0), (0, 'd.x.y', 'n', 2), (0, 'd.z', 'n', 1), (1, 'in', 'n', 3), (1, 'out', 'negative', 0), (2, 'in', 'not_a_count', 0), (2, 'out', 'n', 2), (3, 'd', 'n', 7),
 (4, '', 'empty', 0), (5, '', 'empty', 0), (6, 'd.x.y', 'n', 5), (6, 'out', 'not_a_count', 0), (7, 'in', 'n', 4), (7, 'e', 'not_a_count', 0), (8, 'out', 'n', 6)) t(m, p, k, v) ON m = mm), v_clash AS (SELECT key FROM v_flat GROUP BY 1 HAVING count(*) FILTER (path = 'd') > 0 AND count(*) FILTER (path LIKE 'd.%') > 0)"""


@query(f"WITH {_flat} SELECT key, path, CAST(sum(v) AS BIGINT) AS total FROM v_flat WHERE k = 'n' AND NOT (path = 'd' AND key IN (SELECT key FROM v_clash)) GROUP BY 1, 2")
def nested_usage_totals(spark, sf):
    return U.nested_usage(_sql(spark, sf, ["lineitem"], USAGE.replace("{s}", "STRING")), "l_orderkey", "usage")[0]


@query(f"WITH {_flat} SELECT key, path, k AS code, count(*) AS n FROM v_flat WHERE k <> 'n' GROUP BY 1, 2, 3 UNION ALL SELECT key, 'd', 'shape_conflict', count(*) FROM v_flat WHERE path = 'd' AND key IN (SELECT key FROM v_clash) GROUP BY 1")
def nested_usage_faults(spark, sf):
    return U.nested_usage(_sql(spark, sf, ["lineitem"], USAGE.replace("{s}", "STRING")), "l_orderkey", "usage")[1]
