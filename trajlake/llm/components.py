"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.workspace import written


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (the smallest node reachable) of every node of the edges (a, b).

    Each round links the larger neighbours of a node to its smallest one, then the smaller ones; it
    ends when a round changes nothing, and raises if that takes more than ``most_rounds``. Rounds are written to the shared folder, so lineage stays short.
    Self-loops and repeated edges are harmless; nodes without an edge to another are not returned.
    """
    now = written(edges.select("a", "b").where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct())
    mark = _mark(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) as m")
        large = both.join(least, "a").where("b > a").selectExpr("b as a", "m as b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b <> m").selectExpr("b as a", "m as b").unionByName(lower.selectExpr("a", "m as b")).distinct()
        now = written(small, mark[0])  # a star step adds no edges
        after = _mark(now)
        if after == mark:
            break
        mark = after
    else:
        raise RuntimeError(f"components still changed after {most_rounds} rounds")
    return now.selectExpr("a as node", "b as root").unionByName(now.selectExpr("b as node", "b as root").distinct())


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]
