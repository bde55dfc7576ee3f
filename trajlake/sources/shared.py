"""Folders that the driver and all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local() -> str:
    return "file://" + tempfile.mkdtemp(prefix="trajlake-")


def new_folder(spark: SparkSession) -> str:
    """A new folder's name below ``spark.checkpoint.dir``; where that is unset, a local session gets a temporary one and a cluster raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(root or _local()).rstrip('/')}/files/{uuid.uuid4().hex}"
