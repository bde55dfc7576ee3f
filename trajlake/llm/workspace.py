"""Shared-folder helpers: every intermediate table goes where all executors can read it."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders of the scratches open in this thread, outermost first.
_open: ContextVar[tuple[str, ...]] = ContextVar("open_scratches", default=())


@functools.cache
def _local() -> str:
    return "file://" + tempfile.mkdtemp(prefix="trajlake-")


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _local()
    return f"{root.rstrip('/')}/trajlake"


def shared_dir(spark: SparkSession) -> str:
    """A new folder's name below ``spark.checkpoint.dir``, within the innermost open scratch of this thread.

    Where that setting is unset, a local session (tests) gets a temporary one; a cluster raises.
    """
    return f"{(_open.get() or (_root(spark),))[-1]}/{uuid.uuid4().hex}"


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written within are deleted at the end, in this thread's block alone; what is to outlive it goes through ``kept``."""
    folder = shared_dir(spark)
    token = _open.set((*_open.get(), folder))
    try:
        yield
    finally:
        _open.reset(token)
        delete(spark, folder)


#: Rows of a file of a table whose number of rows is known.
FILE_ROWS = 1_000_000


def written(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder as Parquet and read it back.

    ``rows``, if the caller knows a bound of them, lets a small table be few files instead of one a partition.
    """
    return _written(df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS))), shared_dir(df.sparkSession))


def kept(df: DataFrame) -> DataFrame:
    """Like ``written``, but outside the innermost open scratch, so that the table outlives it."""
    around = _open.get()
    token = _open.set(around[:-1])
    try:
        path = shared_dir(df.sparkSession)
    finally:
        _open.reset(token)
    return _written(df, path)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """Only the named columns, so that clashing extra columns never reach an operator."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"), *[df[c].alias(c) for c in others])
