"""Readers of the files that trajectory pipelines leave behind: records, traces, blobs."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Keys that may hold the list of records of a JSON document, in order.
CONTAINERS = ("records", "instances", "data", "tasks")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1, blank ones counted) and value of every line of text files of any size.

    Spark reads a file in blocks: a line's number is its place in its block and the lines of the blocks before, which are counted
    apart and added up, a row a block. No file is read whole and no line is moved.
    """
    def read() -> DataFrame:
        named = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), "value")
        return named.withColumn("_id", F.monotonically_increasing_id())  # consecutive in a block

    blocks = read().groupBy("file", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "_start", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return read().join(blocks, ["file", "_start"]).select("file", (F.col("_id") - F.col("_first") + F.col("_before") + 1).alias("line"), "value")


def _is_object(c: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False))


def json_records(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """One row (file, position, raw) per record of JSON-lines files, or of JSON arrays, containers or single objects.

    ``lines`` says what the files are; if it is not given, each file tells by its content: a file is one document if its first line that is not
    blank begins an array, is no JSON by itself, or is an object and the only one; else it is JSON lines. ``position`` is the line's
    number, from 1, or the record's place in the document. ``raw`` stays text: records are dynamic. Lines or rows that hold no
    object are left in with raw null, so that a caller can name them. Only files that are one document are read whole.
    """
    numbered = numbered_lines(spark, path).where(F.length(F.trim("value")) > 0)
    by_line = numbered.select("file", F.col("line").alias("position"), F.when(_is_object(F.col("value")), F.col("value")).alias("raw"))
    if lines:
        return by_line
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    if lines is None:
        first = numbered.groupBy("file").agg(F.count("*").alias("n"), F.min_by(F.struct("value"), "line")["value"].alias("v"))
        one = F.ltrim("v").startswith("[") | F.try_parse_json("v").isNull() | ((F.col("n") == 1) & _is_object(F.col("v")))
        kinds = first.select("file", one.alias("one"))
        documents = [r["file"] for r in kinds.where("one").select("file").collect()]  # names of files, not their rows
        by_line = by_line.join(kinds.where("not one").select("file"), "file", "left_semi")
        if not documents:
            return by_line
        whole = spark.read.text([unquote(f) for f in documents], wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    listed = F.coalesce(*[F.get_json_object("value", f"$.{c}") for c in CONTAINERS])
    items = F.when(F.ltrim(F.regexp_replace("value", r"^\s+", "")).startswith("["), F.col("value")).otherwise(F.coalesce(listed, F.concat(F.lit("["), F.col("value"), F.lit("]"))))
    exploded = whole.select("file", items.alias("i")).select("file", F.posexplode(F.expr("cast(try_parse_json(i) as array<variant>)")).alias("position", "v"))
    text = F.to_json("v")
    in_documents = exploded.select("file", F.col("position").cast("long"), F.when(text.startswith("{"), text).alias("raw"))
    return in_documents if lines is False else by_line.unionByName(in_documents)


def trace_lines(spark: SparkSession, path: str) -> DataFrame:
    """Events of JSON-lines trace files: job_id (the file's name), line, raw, ok, last and unterminated.

    A file's lines are kept in order by reading it whole: a trace is one agent run, bounded by its budget.
    Only an unterminated last line may be broken: that is a truncated trace.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").load(path).select(F.regexp_extract("path", r"([^/]+)\.jsonl$", 1).alias("job_id"), F.col("content").cast("string").alias("text"))
    split = files.select("job_id", (~F.col("text").endswith("\n") & (F.col("text") != "")).alias("open_end"), F.posexplode(F.split("text", "\n")).alias("line", "raw")).where(F.length(F.trim("raw")) > 0)
    last = F.col("line") == F.max("line").over(Window.partitionBy("job_id"))
    return split.select("job_id", "line", "raw", F.expr("try_parse_json(raw) is not null").alias("ok"), last.alias("last"), F.col("open_end"))


def trace_status(lines: DataFrame) -> DataFrame:
    """Per trace: valid, truncated (only its open last line is broken) or invalid, and its events."""
    broken = ~F.col("ok")
    out = lines.groupBy("job_id").agg(F.count(F.when(F.col("ok"), 1)).alias("events"), F.count(F.when(broken & ~(F.col("last") & F.col("open_end")), 1)).alias("bad"), F.count(F.when(broken & F.col("last") & F.col("open_end"), 1)).alias("cut"))
    return out.select("job_id", "events", F.when(F.col("bad") > 0, "invalid").when(F.col("cut") > 0, "truncated").otherwise("valid").alias("status"))


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """Content-addressed files (sha256/ab/<digest>): digest, size and whether the content has that digest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"([0-9a-f]{64})$", 1).alias("digest"), F.col("length").alias("size"), (F.sha2("content", 256) == F.regexp_extract("path", r"([0-9a-f]{64})$", 1)).alias("intact")).where("digest <> ''")


def allowlist_records(spark: SparkSession, path: str) -> DataFrame:
    """One row (position, raw) per repository of an allowlist: JSON lines, an array, or an object that holds ``repositories``."""
    if path.endswith(".jsonl"):
        return json_records(spark, path, lines=True)
    whole = spark.read.text(path, wholetext=True)
    listed = F.coalesce(F.get_json_object("value", "$.repositories"), F.when(F.ltrim("value").startswith("["), F.col("value")), F.concat(F.lit("["), F.col("value"), F.lit("]")))
    items = whole.select(listed.alias("i")).select(F.posexplode(F.expr("cast(try_parse_json(i) as array<variant>)")).alias("position", "v"))
    text = F.to_json("v")
    return items.select(F.col("position").cast("long"), F.when(text.startswith("{"), text).alias("raw"))


def paged_rows(spark: SparkSession, path: str, offset: int, length: int) -> DataFrame:
    """Rows offset to offset + length of saved pages of a rows API ({"rows": [{"row_idx": n, "row": {...}}]}): row_idx, raw."""
    if offset < 0 or length < 1:
        raise ValueError("offset must be 0 or more and length 1 or more")
    pages = spark.read.text(path, wholetext=True).select(F.explode(F.expr("try_variant_get(try_parse_json(value), '$.rows', 'array<variant>')")).alias("r"))
    rows = pages.select(F.try_variant_get("r", "$.row_idx", "bigint").alias("row_idx"), F.to_json(F.try_variant_get("r", "$.row", "variant")).alias("raw"))
    return rows.where((F.col("row_idx") >= offset) & (F.col("row_idx") < offset + length) & F.col("raw").startswith("{"))


def registry_scenarios(spark: SparkSession, folder: str) -> DataFrame:
    """Scenarios of a registry folder (scenarios/*.json), in order of id: scenario_id, raw."""
    files = spark.read.text(f"{folder}/scenarios/*.json", wholetext=True)
    return files.select(F.get_json_object("value", "$.scenario_id").alias("scenario_id"), F.col("value").alias("raw")).where("scenario_id is not null").orderBy("scenario_id")


def resumed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Ids that an earlier export to JSON lines already holds, each once."""
    return json_records(spark, path, lines=True).select(F.get_json_object("raw", f"$.{key}").alias(key)).where(f"{key} is not null").distinct()
