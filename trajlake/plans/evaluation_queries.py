"""Queries over evaluations, selections and content ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions.ids import has_key, stable_id
from trajlake.operators import evaluation as E
from trajlake.operators import interactions as I
from trajlake.operators import selection as S
from trajlake.plans import adapters as A
from trajlake.plans import corpus_queries as CQ
from trajlake.plans import trace_queries as TQ
from trajlake.plans.registry import query

PUBLIC = ("tool_calls", "verifier_hidden_command_passed")


@query("SELECT event_id, 'evt_' || substr(sha256('{\"k\":' || json_extract_string(props, '$.k') || '}'), 1, 16) AS stable_id FROM events")
def stable_ids(spark, sf):
    return A.table(spark, sf, "events").select("event_id", stable_id("evt", F.col("props")).alias("stable_id"))


#: Names of a nested field and a value beside it, by page; with whether the name is a forbidden one.
_NAMES = [("Hidden-Tests", "x", True), ("hidden\\u005ftests", "x", True), ("tests", 'say \\"hidden_tests\\": no', False), ("REFERENCE answer", "", True), ("hidden_tests_note", "hidden_tests", False), ('a\\"reference_answer', "reference_answer:", False)]


def _nested(values: list[str]) -> str:
    return f"CASE CAST(page_id % {len(_NAMES)} AS INT) " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values)) + " END"


@query(f"SELECT page_id, {_nested([str(n[2]) for n in _NAMES])} AND coalesce(html, '') NOT LIKE '%<table%' AS forbidden FROM pages")
def forbidden_fields(spark, sf):
    p = A.table(spark, sf, "pages")
    name, said = (F.expr(_nested(["r'" + n[k] + "'" for n in _NAMES])) for k in (0, 1))
    inner = F.concat(F.lit('[{"'), name, F.lit('": "'), said, F.lit('"}]'))
    raw = F.concat(F.lit('{"page": '), F.to_json(F.struct("url", "html")), F.lit(', "deep": {"list": [1, '), inner, F.when(F.coalesce("html", F.lit("")).contains("<table"), "").otherwise("]}}"))
    return p.select("page_id", has_key(raw, ["hidden_tests", "reference_answer"]).alias("forbidden"))


@query(
    f"""WITH {A.JOBS} SELECT job_id, CAST(1 + CASE WHEN m_hidden IS NULL THEN 0 ELSE 1 END AS BIGINT) AS public_metrics, CAST(2 AS BIGINT) AS omitted, sha256('{{"tool_calls":' || m_tool_calls || ',"verifier_agent_termination_passed":' || m_stop || ',"verifier_all_non_agent_passed":' || m_all
 || CASE WHEN m_hidden IS NULL THEN '' ELSE ',"verifier_hidden_command_passed":' || m_hidden END || '}}') AS metrics_sha256 FROM v_jobs"""
)
def public_metrics(spark, sf):
    kept = E.public_metrics(F.col("metrics"), PUBLIC)
    return A.jobs(spark, sf).select("job_id", F.size(kept).cast("long").alias("public_metrics"), (F.size("metrics") - F.size(kept)).cast("long").alias("omitted"), E.metrics_digest(F.col("metrics")).alias("metrics_sha256"))


def _reasons(spark, sf):
    return TQ._results(spark, sf).withColumn("reason", F.concat(F.lit("exit "), F.col("position").cast("string")))


@query(f"WITH {TQ.RESULTS} SELECT job_id, position, CASE WHEN verifier = 'hidden_command' THEN verifier ELSE 'custom_evaluator_' || substr(sha256(verifier), 1, 16) END AS evaluator, passed, CASE WHEN passed THEN 'passed' ELSE 'failed' END AS reason, sha256('exit ' || CAST(position AS VARCHAR)) AS reason_sha256, octet_length(encode('exit ' || CAST(position AS VARCHAR))) AS reason_bytes FROM v_results")
def public_results(spark, sf):
    return E.public_results(_reasons(spark, sf), ("hidden_command",))


@query(f"WITH {TQ.RESULTS} SELECT job_id, string_agg(verifier, ',' ORDER BY position) <> 'agent_termination,hidden_command' OR (job_id % 3 = 0 AND NOT bool_and(passed AND NOT infra)) AS bypassed FROM v_results GROUP BY job_id")
def verifier_bypass(spark, sf):
    return E.bypassed(TQ._results(spark, sf).withColumn("claimed", F.col("job_id") % 3 == 0), ["agent_termination", "hidden_command"])


@query(
    f"""WITH {A.TRACE}, {TQ.OUT}, t AS (SELECT session_id, CAST(substr(session_id, 2) AS BIGINT) AS n, success, tool_calls FROM v_out)
 SELECT session_id, array_to_string(list_filter([CASE WHEN n % 7 = 0 THEN 'no_report' END, CASE WHEN n % 5 = 0 THEN 'not_finished' END, CASE WHEN n % 7 <> 0 AND (n % 4 = 0) <> success THEN 'success_differs' END, CASE WHEN n % 7 <> 0 AND n % 3 = 0 THEN 'results_differ' END], lambda x: x IS NOT NULL), ',') AS codes FROM t"""
)
def export_preconditions(spark, sf):
    from trajlake.operators import traces as T

    n = F.substring("session_id", 2, 30).cast("long")
    out = T.outcomes(A.trace(spark, sf)).select("session_id", "success", (n % 5 != 0).alias("finished"), F.col("tool_calls").alias("results"))
    reports = out.where(n % 7 != 0).select("session_id", (n % 4 == 0).alias("report_success"), (F.col("results") + F.when(n % 3 == 0, 1).otherwise(0)).alias("report_results"))
    return E.preconditions(out, reports)


@query(f"WITH {TQ.RESULTS}, a AS (SELECT job_id, string_agg(verifier || passed || infra, ';' ORDER BY position) AS s FROM v_results GROUP BY 1), b AS (SELECT job_id, string_agg(verifier || (CASE WHEN job_id % 10 = 3 THEN NOT passed ELSE passed END) || infra, ';' ORDER BY position) AS s FROM v_results WHERE job_id % 4 <> 0 GROUP BY 1) SELECT job_id, CASE WHEN b.s IS NULL THEN 'missing' WHEN a.s = b.s THEN 'reproduced' ELSE 'different' END AS outcome FROM a LEFT JOIN b USING (job_id)")
def reproduction_check(spark, sf):
    r = TQ._results(spark, sf)
    return E.reproduced(r, r.where("job_id % 4 <> 0").withColumn("passed", F.when(F.col("job_id") % 10 == 3, ~F.col("passed")).otherwise(F.col("passed"))))


@query("SELECT CAST(doc_id AS VARCHAR) AS path, CASE WHEN doc_id % 2 = 0 THEN 'contains' ELSE 'equals' END AS kind, CASE WHEN doc_id % 9 = 0 OR text IS NULL THEN false WHEN doc_id % 2 = 0 THEN contains(text, 'the') ELSE text = substr(text, 1, 40) END AS passed FROM documents")
def state_checks(spark, sf):
    d = A.table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("path"), "text")
    required = d.select("path", F.when(F.col("doc_id") % 2 == 0, "contains").otherwise("equals").alias("kind"), F.when(F.col("doc_id") % 2 == 0, "the").otherwise(F.substring("text", 1, 40)).alias("expected"))
    return E.state_checks(required, d.where("doc_id % 9 <> 0").select("path", F.col("text").alias("content")))


@query("SELECT conv_id, turn, contains(t, 'thea and the') OR (contains(t, 'thea') AND contains(t, 'and') AND contains(t, 'the')) AS satisfied FROM (SELECT conv_id, turn, regexp_replace(lower(text), '\\s+', ' ', 'g') AS t FROM conversations)")
def trace_requirements(spark, sf):
    return A.table(spark, sf, "conversations").select("conv_id", "turn", E.requirement_met(F.col("text"), "thea and  the").alias("satisfied"))


@query("""WITH s AS (SELECT conv_id, split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3) AS secret FROM conversations WHERE turn = 1), p AS (SELECT conv_id, text AS public_text FROM conversations WHERE turn = 0)
 SELECT 's' || CAST(c.conv_id AS VARCHAR) AS session_id, sha256(secret) AS secret_sha256, count(*) AS events FROM conversations c JOIN s ON s.conv_id = c.conv_id JOIN p ON p.conv_id = c.conv_id WHERE length(secret) >= 8 AND NOT contains(public_text, secret) AND contains(c.text, secret) GROUP BY 1, 2""")
def hidden_leak_findings(spark, sf):
    m = A.messages(spark, sf)
    first = m.where("sequence = 0").select("session_id", F.col("content").alias("public_text"))
    secret = m.where("sequence = 1").select("session_id", F.concat(F.split_part("content", F.lit(" "), F.lit(2)), F.lit(" "), F.split_part("content", F.lit(" "), F.lit(3))).alias("secret"))
    return E.hidden_leaks(m.select("session_id", "content"), secret.join(first, "session_id"))


_q = "lower(text)"


@query(f"""SELECT conv_id, turn, CASE WHEN turn > 6 THEN 'stop' WHEN contains({_q}, 'elle') THEN 'correct' WHEN contains({_q}, 'the_of') OR contains({_q}, 'the of') OR contains({_q}, 'anda') THEN 'clarify' WHEN contains({_q}, 'schö') THEN 'refuse' WHEN contains({_q}, 'confirm') OR contains({_q}, 'proceed') THEN 'confirm' ELSE 'refuse' END AS action FROM conversations WHERE role = 'user'""")
def simulator_actions(spark, sf):
    return A.table(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", E.simulated_action(F.col("text"), F.col("turn"), 6, ["elle"], ["the_of", "anda"], ["schö"]).alias("action"))


@query("SELECT conv_id, turn, name, NOT contains(lower(coalesce(prev, '')), name) AS unasked FROM (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) JOIN (VALUES ('of the'), ('and')) t(name) ON contains(lower(text), name)")
def fact_disclosure(spark, sf):
    return I.disclosures(A.table(spark, sf, "conversations"), ["Of the", "and", " "])


@query(f"WITH {A.RECORDS}, x AS (SELECT position, unnest(list_filter([CASE WHEN NOT regexp_full_match(revision, '[0-9a-f]{{40}}') THEN 'revision.fixed' END, CASE WHEN NOT has_verifier THEN 'verifier.present' END, CASE WHEN length(title) = 0 THEN 'title.present' END], lambda v: v IS NOT NULL)) AS code FROM v_records) SELECT * FROM x")
def gate_issue_rows(spark, sf):
    rules = {"revision.fixed": F.col("revision").rlike("^[0-9a-f]{40}$"), "verifier.present": F.col("has_verifier"), "title.present": F.length("title") > 0}
    return E.rule_rows(A.records(spark, sf), "position", rules)


@query(f"WITH {A.RECORDS} SELECT 'records' AS gate, count(*) >= 20 AS passed FROM v_records UNION ALL SELECT 'repositories', count(DISTINCT repository) >= 8 FROM v_records UNION ALL SELECT 'languages', count(DISTINCT language) >= 2 FROM v_records")
def freeze_gates(spark, sf):
    from trajlake.operators.review import gates

    r = A.records(spark, sf).agg(F.count("*").alias("n"), F.countDistinct("repository").alias("r"), F.countDistinct("language").alias("l"))
    return gates(r, {"records": F.col("n") >= 20, "repositories": F.col("r") >= 8, "languages": F.col("l") >= 2})


@query(f"WITH {A.JOBS} SELECT trace_id, count(*) AS runs, CAST(max(success) AS BIGINT) AS reward, sha256(trace_id) AS trace_sha256 FROM v_jobs WHERE status = 'completed' GROUP BY trace_id")
def analysis_records(spark, sf):
    return A.jobs(spark, sf).where("status = 'completed'").groupBy("trace_id").agg(F.count("*").alias("runs"), F.max("success").cast("long").alias("reward")).withColumn("trace_sha256", F.sha2("trace_id", 256))


@query(CQ._GAPS + ", r AS (SELECT CAST(coalesce(max(CASE WHEN dimension = 'verifier_types' THEN most ELSE total END), 0) AS BIGINT) AS reserved FROM (SELECT dimension, sum(gap) AS total, max(gap) AS most FROM g GROUP BY 1)) SELECT reserved, CAST(greatest(0, 1000 - reserved) AS BIGINT) AS existing_target FROM r")
def reserved_slots(spark, sf):
    return S.reserved_slots(CQ._gaps(spark, sf), 1000)


@query()
def greedy_seed_selection(spark, sf):
    """No SQL: a greedy choice with counters; tests hold it against a plain loop."""
    seeds = A.seeds(spark, sf).where("train_eligible").select("seed_id", "task_family", "source_method", "repository", "language")
    return S.balanced(seeds, 60, {"task_family": 0.25, "source_method": 0.65, "repository": 0.1, "language": 0.5})


@query()
def greedy_review_sample(spark, sf):
    """No SQL: greedy coverage; tests hold it against a plain loop."""
    return S.covering(TQ._risk(spark, sf).select("trace_id", "scenario_id", "success", "termination", "risk_score"), 20, ["scenario_id", "success", "termination"])
