"""Approximate nearest neighbours by cosine: inverted lists and an adaptive dimension scan.

Unit vectors are rotated at random and dealt to lists by their nearest centroid (spherical k-means on a
bounded sample). How many lists a query visits is read off the same sample: as many, nearest first, as
hold ``recall`` of the exact neighbours of some of its vectors. Lists are laid side by side in blocks of
bounded size, near lists in the same block, and a query travels once to each block that holds a list of
its own. There, nearest list first, candidates are scanned in column blocks of the rotated dimensions: the
partial squared distance estimates the whole one, and a candidate is abandoned as soon as the test says
that it lies beyond the current k-th distance. What is left is scored exactly, in double precision, on the
original vectors. Queries that found fewer than k candidates visit every list.

A list larger than a block fills several, so a common vector fills many blocks and no task. Vectors
without any cluster among them are the hard case: a query then has to visit many lists, and the scan, not
the lists, saves the work.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors
are compared with those of equal length only; ties go to the smaller id; rows with one id are rows of
their own, each a query if the id asks for it, and only the query's own row is no candidate; huge and tiny
components neither overflow nor vanish; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm.blocks import partitions_for
from trajlake.llm.workspace import written

COLUMN_BLOCK = 16
EPSILON = 2.1


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("vec")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.select(df[id_col].cast("long").alias("vec_id"), df[vec_col].cast("array<double>").alias("vec")).where(v.isNotNull() & (F.size(v) > 0)).where(fine)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def nearest(x: np.ndarray, centre: np.ndarray, rows: int = 2048) -> np.ndarray:
    """Place of each row's nearest centroid, some rows at a time."""
    return np.concatenate([np.argmax(x[k : k + rows] @ centre.T, axis=1) for k in range(0, len(x), rows)]) if len(x) else np.zeros(0, np.int64)


def centroids(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means on distinct unit vectors."""
    points = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    c = points[rng.choice(len(points), min(lists, len(points)), replace=False)]
    for _ in range(rounds):
        near = nearest(points, c)
        total = np.zeros_like(c)
        np.add.at(total, near, points)
        size = np.linalg.norm(total, axis=1)
        c[size > 1e-9] = total[size > 1e-9] / size[size > 1e-9, None]
    return c


def visits(sample: np.ndarray, centre: np.ndarray, k: int, recall: float, queries: int = 256, seed: int = 3) -> int:
    """Lists, nearest first, that hold ``recall`` of the k exact neighbours of some of the sample's vectors."""
    if len(sample) < 2:
        return 1
    asked = np.random.default_rng(seed).choice(len(sample), min(queries, len(sample)), replace=False)
    near = sample[asked] @ sample.T
    near[np.arange(len(asked)), asked] = -np.inf
    found = np.argpartition(-near, min(k, len(sample) - 1) - 1, axis=1)[:, : min(k, len(sample) - 1)]
    home = nearest(sample, centre)
    place = np.argsort(np.argsort(-(sample[asked] @ centre.T), axis=1, kind="stable"), axis=1)
    ranks = np.sort(np.take_along_axis(place, home[found], axis=1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1


def adaptive_scan(x: np.ndarray, q: np.ndarray, k: int, chunk: int = 256) -> tuple[np.ndarray, int]:
    """Rows of rotated ``x`` that may be among the k nearest to rotated ``q``, and the components read."""
    dims = x.shape[1]
    held, reach, read = [], np.inf, 0
    best = np.zeros(0)
    for at in range(0, len(x), chunk):
        row = np.arange(at, min(at + chunk, len(x)))
        part = np.zeros(len(row))
        for c in range(0, dims, COLUMN_BLOCK):
            stop = min(c + COLUMN_BLOCK, dims)
            gap = x[row, c:stop] - q[c:stop]
            part = part + np.einsum("ij,ij->i", gap, gap)
            read += len(row) * (stop - c)
            if reach < np.inf:
                bound = reach * (1 + EPSILON / np.sqrt(stop)) ** 2 if stop < dims else reach
                stay = part * (dims / stop) <= bound + 1e-9
                row, part = row[stay], part[stay]
                if not len(row):
                    break
        held.append(row)
        best = np.sort(np.concatenate([best, part]))[:k]
        if len(best) == k:
            reach = best[-1]
    return (np.concatenate(held) if held else np.zeros(0, np.int64)), read


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither overflow nor vanish; no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def exact_cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine in double precision, row by row in the same order of operations."""
    x, q = scaled(x), scaled(q)
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def blocks_of(sizes: np.ndarray, centre: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each list and the number of blocks it is spread over; small lists near each other share one."""
    coarse = centroids(centre, max(1, int(np.sqrt(len(centre)))))
    order = np.argsort(nearest(centre, coarse), kind="stable")
    first, spread = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // most))
    block, fill = -1, most
    for i in order.tolist():
        if spread[i] > 1:
            first[i] = block + 1
            block, fill = block + int(spread[i]), most
        else:
            if fill + sizes[i] > most:
                block, fill = block + 1, 0
            first[i] = block
            fill += int(sizes[i])
    return first, spread


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5, sample: int = 20_000, recall: float = 0.96, block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``.

    ``sample`` bounds the rows that fit the index, ``recall`` is the share of exact neighbours that the
    visited lists shall hold, ``block`` the most rows of a block.
    """
    valid = written(_valid(df, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()))
    sizes = {r["d"]: r["n"] for r in valid.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}  # one row a length
    out = None
    for dims, n in sorted(sizes.items()):
        found = _search_dims(valid.where(F.size("vec") == dims), dims, n, every, k, sample, recall, block)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return valid.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    return out


def fitted(valid: DataFrame, n: int, dims: int, k: int, sample: int, recall: float) -> tuple[np.ndarray, int]:
    """Centroids and the number of lists to visit, from at most 2 * ``sample`` rows."""
    picked = valid if n <= sample else valid.where(F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < int(1e6 * sample / n) + 1)
    fit = _unit(_matrix(picked.select("vec").limit(2 * sample).toArrow().column(0))) if n else np.zeros((0, dims))
    if not len(fit):
        return np.eye(1, dims), 1
    centre = centroids(fit, max(1, min(4 * int(np.sqrt(n)), len(fit) // 4)))
    return centre, min(len(centre), visits(fit, centre, k, recall))


def _search_dims(valid: DataFrame, dims: int, n: int, every: int, k: int, sample: int, recall: float, block: int) -> DataFrame:
    centre, visit = fitted(valid, n, dims, k, sample, recall)
    lists = len(centre)
    turn = rotation(dims)

    def deal(batches):
        for b in batches:
            if b.num_rows:
                near = nearest(_unit(_matrix(b.column(2))), centre).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near), b.column(2)], names=["row", "vec_id", "list", "vec"])

    dealt = written(valid.select("row", "vec_id", "vec").mapInArrow(deal, "row long, vec_id long, list int, vec array<double>"))
    sizes = np.zeros(lists, np.int64)
    for r in dealt.groupBy("list").agg(F.count("*").alias("n")).collect():  # one row a list
        sizes[r["list"]] = r["n"]
    first, spread = blocks_of(sizes, centre, block)
    table = valid.sparkSession.createDataFrame([(i, int(first[i]), int(spread[i])) for i in range(lists)], "list int, first long, spread long")
    store = dealt.join(F.broadcast(table), "list").select("row", "vec_id", "vec", "list", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("spread"))).alias("block"))
    parts = partitions_for(valid, int((first + spread).max()), 1)

    def probes(count: int):
        """One row per query and block: the query and its lists there, nearest first."""

        def run(batches):
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    near = np.argsort(-(_unit(_matrix(part.column(2))) @ centre.T), axis=1, kind="stable")[:, :count]
                    query, own = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
                    filled = sizes[own] > 0
                    query, own = query[filled], own[filled]
                    times = spread[own]
                    ahead = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                    query, own = np.repeat(query, times), np.repeat(own, times)
                    there = first[own] + ahead
                    order = np.lexsort((np.arange(len(there)), there, query))
                    query, own, there = query[order], own[order], there[order]
                    new = np.ones(len(query), bool)
                    new[1:] = (query[1:] != query[:-1]) | (there[1:] != there[:-1])
                    begin = np.flatnonzero(new)
                    at_list = pa.ListArray.from_arrays(pa.array(np.append(begin, len(own)).astype(np.int32)), pa.array(own.astype(np.int32)))
                    take = pa.array(query[begin])
                    yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(there[begin]), at_list, part.column(2).take(take)], names=["row", "vec_id", "block", "lists", "vec"])

        return run

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            own, ids, mine = _matrix(left["vec"]), left["vec_id"].to_numpy(), left["row"].to_numpy()
            asked, query, theirs = _matrix(right["vec"]), right["vec_id"].to_numpy(), right["row"].to_numpy()
            x, y = _unit(own) @ turn, _unit(asked) @ turn
            home = left["list"].to_numpy()
            order = np.argsort(home, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(home, minlength=lists)))
            for i, wanted in enumerate(right["lists"].to_pylist()):
                at = np.concatenate([order[ends[w] : ends[w + 1]] for w in wanted])
                at = at[mine[at] != theirs[i]]
                near = at[adaptive_scan(x[at], y[i], k)[0]]
                score = exact_cosine(own[near], asked[i])
                for j in np.lexsort((ids[near], -score))[:k].tolist():
                    rows.append((int(theirs[i]), int(query[i]), int(ids[near[j]]), float(score[j])))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["row", "query_id", "vec_id", "score"])

    def visited(queries: DataFrame, count: int) -> DataFrame:
        asks = queries.mapInArrow(probes(count), "row long, vec_id long, block long, lists array<int>, vec array<double>")
        met = store.repartition(parts, "block").groupBy("block").cogroup(asks.repartition(parts, "block").groupBy("block")).applyInArrow(scan, "row long, query_id long, vec_id long, score double")
        order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
        return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    queries = dealt.where(F.pmod("vec_id", F.lit(every)) == 0).select("row", "vec_id", "vec")
    found = written(visited(queries, visit))
    if visit < lists:
        full = found.groupBy("row").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, n - 1)).select("row")
        short = written(queries.join(full, "row", "left_anti"))
        if not short.isEmpty():
            found = found.join(full, "row", "left_semi").select(found.columns).unionByName(visited(short, lists).select(found.columns))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
