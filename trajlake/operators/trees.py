"""Hash of a folder tree: SHA-256 over the JSON list of its entries in order of their path's parts.

An entry is a file with its content's hash, a link with its target, or a folder; what lies in ``.git`` at the root does not count. One
huge tree is no task of its own: its entries are sorted by ranges, and ordered runs of them are hashed as they stream by.

Cases: a tree of no entries has no row (its hash is that of ``[]``); a repeated path counts once, the first by kind and hash; a null path, tree or an unknown kind takes
no part; paths may hold any character.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.operators.digests import ordered_digests

KINDS = ("dir", "file", "symlink")


def entry(path: str, kind: str, sha256: str | None, target: str | None) -> str:
    """Canonical JSON of an entry."""
    own = {"path": path, "type": kind} | ({"sha256": sha256} if kind == "file" else {"target": target} if kind == "symlink" else {})
    return json.dumps(own, sort_keys=True, separators=(",", ":"))


def tree_hashes(entries: DataFrame) -> DataFrame:
    """tree_id, entries and tree_sha256; entries: tree_id, path, kind, sha256 (of a file) and target (of a link)."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [entry(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("path", "kind", "sha256", "target")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lines, pa.string())], names=["tree_id", "path", "line"])

    git = (F.col("path") == ".git") | F.col("path").startswith(".git/")
    some = entries.select(F.col("tree_id").cast("string").alias("tree_id"), "path", "kind", "sha256", "target").where(F.col("tree_id").isNotNull() & F.col("path").isNotNull() & ~git & F.col("kind").isin(*KINDS))
    once = some.groupBy("tree_id", "path").agg(F.min(F.struct("kind", "sha256", "target")).alias("e")).select("tree_id", "path", "e.*")
    lines = once.mapInArrow(spelled, "tree_id string, path string, line string")
    made = ordered_digests(lines, F.col("tree_id"), F.split("path", "/", -1), F.col("line"), ",", "[", "]")
    return made.select(F.col("key").alias("tree_id"), F.col("n").alias("entries"), F.col("sha256").alias("tree_sha256"))


def folder_entries(spark: SparkSession, root: str, tree_id: str) -> DataFrame:
    """Entries of the files below a folder and of the folders that hold them, hashed where they are read.

    A store lists files only, so empty folders and links are not seen; those come from a table of their own.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inner = F.substring(F.regexp_replace("path", r"^[a-zA-Z][\w+.-]*:/*(?=/)", ""), len(base) + 2, 1 << 30)
    found = files.select(F.lit(tree_id).alias("tree_id"), inner.alias("path"), F.lit("file").alias("kind"), F.sha2("content", 256).alias("sha256"), F.lit(None).cast("string").alias("target"))
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    folders = found.where(F.contains("path", F.lit("/"))).select("tree_id", F.explode(above).alias("path")).distinct()
    return found.unionByName(folders.select("tree_id", "path", F.lit("dir").alias("kind"), F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("string").alias("target")))
