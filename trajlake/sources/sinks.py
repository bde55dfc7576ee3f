"""Sinks: JSON-lines exports with a manifest, and append-only logs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a file at most, so that a file's digest can be taken of one value.
FILE_ROWS = 1_000_000


def json_line(columns: list[str]) -> Column:
    """A row as JSON with its keys in order at every depth, without null fields and without blanks."""
    return F.to_json(F.parse_json(F.to_json(F.struct(*columns))))


def write_jsonl(df: DataFrame, path: str) -> DataFrame:
    """Write rows as JSON lines with sorted keys; return a manifest of the files with their digests.

    The rows are written beside the target and moved there once all are, so that readers see the old files or the new ones; a
    lost writer leaves the target as it was.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.select(json_line(df.columns).alias("value")).write.option("maxRecordsPerFile", FILE_ROWS).text(beside)
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(target, True)
    if not store.rename(source, target):
        raise OSError(f"{beside} could not be moved to {path}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def append_jsonl(df: DataFrame, path: str) -> None:
    """Add rows as JSON lines with sorted keys; what is there stays."""
    df.select(json_line(df.columns).alias("value")).write.mode("append").option("maxRecordsPerFile", FILE_ROWS).text(path)


# Groups of versions that a release must declare.
VERSION_GROUPS = ("scenarios", "models", "prompts", "tools", "images", "evaluators", "exporters")


def undeclared_groups(declared: DataFrame) -> DataFrame:
    """Groups that a release lacks, as rows; declared: version_group, version. A blank version declares nothing."""
    needed = declared.sparkSession.createDataFrame([(k, g) for k, g in enumerate(VERSION_GROUPS)], "place int, version_group string")
    told = declared.where(F.trim("version") != "").select("version_group").distinct()
    return needed.join(told, "version_group", "left_anti").orderBy("place").select("version_group")
