"""Tables written out as files in the shapes that readers expect, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.plans import adapters as A
from trajlake.plans.registry import query
from trajlake.plans.strict_queries import _sql
from trajlake.sources import readers, sinks
from trajlake.sources.shared import new_folder


@query("SELECT doc_id, lang, n_chars FROM documents")
def json_lines_round_trip(spark, sf):
    path = new_folder(spark)
    sinks.write_jsonl(A.table(spark, sf, "documents").select("n_chars", "lang", "doc_id"), path)
    return readers.json_records(spark, path, lines=True).select(F.from_json("raw", "doc_id long, lang string, n_chars long").alias("r")).select("r.*")


@query("SELECT CAST(sum(CASE WHEN event_id % 7 IN (1, 2, 3) THEN 0 ELSE 1 END) AS BIGINT) AS objects, CAST(sum(CASE WHEN event_id % 7 IN (1, 2) THEN 1 ELSE 0 END) AS BIGINT) AS others, count(*) AS lines, true AS numbered FROM events")
def json_line_faults(spark, sf):
    path = new_folder(spark)
    line = F.when(F.col("event_id") % 7 == 1, "[1]").when(F.col("event_id") % 7 == 2, "broken {").when(F.col("event_id") % 7 == 3, "  ").otherwise(F.to_json(F.struct("event_id", "props")))
    A.table(spark, sf, "events").select(line.alias("value")).write.text(path)
    every = readers.numbered_lines(spark, path)
    files = every.groupBy("file").agg(F.count("*").alias("n"), F.min("line").alias("low"), F.max("line").alias("high"), F.count_distinct("line").alias("d"))
    whole = files.agg(F.sum("n").alias("lines"), F.bool_and((F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("d") == F.col("n"))).alias("numbered"))
    found = readers.json_records(spark, path, lines=True).agg(F.count("raw").alias("objects"), F.count(F.when(F.col("raw").isNull(), 1)).alias("others"))
    return found.join(F.broadcast(whole))  # one row each


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT n_nationkey, n_name FROM nation")
def json_documents_and_lines(spark, sf):
    path = new_folder(spark)
    A.table(spark, sf, "supplier").select(F.to_json(F.struct("s_suppkey", "s_name")).alias("value")).write.text(f"{path}/lines")
    listed = A.table(spark, sf, "nation").groupBy("n_regionkey").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("n_nationkey").cast("long").alias("s_suppkey"), F.col("n_name").alias("s_name"))).alias("instances"))).alias("value"))
    listed.select("value").repartition(5, "value").write.option("maxRecordsPerFile", 1).text(f"{path}/documents")
    return readers.json_records(spark, f"{path}/*/part-*").select(F.from_json("raw", "s_suppkey long, s_name string").alias("r")).select("r.*")


@query("SELECT doc_id AS row_idx, lang FROM documents WHERE doc_id >= 30 AND doc_id < 530")
def paged_rows(spark, sf):
    path = new_folder(spark)
    row = F.struct(F.col("doc_id").alias("row_idx"), F.struct("lang", "source").alias("row"))
    A.table(spark, sf, "documents").groupBy(F.floor(F.col("doc_id") / 500).alias("p")).agg(F.to_json(F.struct(F.collect_list(row).alias("rows"))).alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.paged_rows(spark, path, 30, 500).select("row_idx", F.get_json_object("raw", "$.lang").alias("lang"))


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 3 <> 1")
def resumed_ids(spark, sf):
    path = new_folder(spark)
    o = A.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("id"), "o_orderkey")
    sinks.append_jsonl(o.where("o_orderkey % 3 = 0"), path)
    sinks.append_jsonl(o.where("o_orderkey % 3 = 2"), path)
    sinks.append_jsonl(o.where("o_orderkey % 3 = 1").select(F.lit(None).cast("string").alias("id"), "o_orderkey"), path)
    return readers.resumed(spark, path, "id")


@query("SELECT 'org/' || s_name AS repository, CASE WHEN s_nationkey % 2 = 0 THEN 'MIT' END AS license FROM supplier")
def allowlist_lines(spark, sf):
    path = f"{new_folder(spark)}/list.jsonl"
    sinks.write_jsonl(_sql(spark, sf, ["supplier"], "SELECT 'org/' || s_name AS repository, CASE WHEN s_nationkey % 2 = 0 THEN 'MIT' END AS license FROM supplier"), path)
    return readers.allowlist_records(spark, path).select(F.get_json_object("raw", "$.repository").alias("repository"), F.get_json_object("raw", "$.license").alias("license"))


@query("SELECT g AS version_group FROM (SELECT unnest(['scenarios', 'models', 'prompts', 'tools', 'images', 'evaluators', 'exporters']) AS g, unnest(range(7)) AS k) WHERE k NOT IN (SELECT p_partkey % 9 FROM part WHERE p_size % 4 <> 0 AND p_partkey % 9 NOT IN (2, 5))")
def undeclared_groups(spark, sf):
    group = F.get(F.array(*[F.lit(g) for g in sinks.VERSION_GROUPS]), (F.col("p_partkey") % 9).cast("int"))
    fine = (F.col("p_size") % 4 != 0) & ~(F.col("p_partkey") % 9).isin(2, 5)
    return sinks.undeclared_groups(A.table(spark, sf, "part").select(group.alias("version_group"), F.when(fine, "1").otherwise(" ").alias("version")))
