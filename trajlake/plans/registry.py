"""Named queries and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function under its name, with its SQL if there is one."""

    def put(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        name = fn.__name__.rstrip("_")
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put
