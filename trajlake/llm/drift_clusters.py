"""Exact centroid clustering on integer vectors, with bounds loosened by geometric drift.

Vectors are kept in pieces: one row of the written table holds some thousand of them, packed, with the
state of each: its cluster, an upper bound of the distance to its own centroid and a lower bound of the
distance to every other. When centroids move, the upper bound grows by its own centroid's drift. The lower
bound need not shrink by the largest drift: all vectors of a cluster lie in a sphere around the centroid they
were assigned to, and for each other centroid that moves from p to q the plane through p, q and the
sphere's centre shows how much nearer q can be than p to any point of the sphere (``loosened``). Vectors
whose bounds still part are not looked at; the others first get their exact own distance, and those that
stay ambiguous are scanned against all centroids in integer arithmetic, ties to the smaller number.

A round writes one new table from the last one, without a shuffle, then sums the changes of the clusters' sums (k x
dims numbers a piece, pre-aggregated) for the driver, which holds k centroids and nothing that grows with the
rows. The table before is deleted, so two stand on disk at most.

Cases: vectors that are null, of another length, or hold null or non-finite components take no part; a component whose
integer lies beyond +-2**27 counts as that bound, so that squared distances stay 64-bit integers; an inertia beyond 64 bits is null; a null id is no
start centroid unless ids run out and comes last among the starts; repeated rows are vectors of their own; with
fewer vectors than k there are as many centroids as vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.llm.workspace import delete, kept, scratch, shared_dir

#: Vectors of a piece.
PIECE = 4096
#: Largest magnitude of a component's integer.
MOST = 1 << 27
#: Margins of the bounds against rounding: relative and absolute.
RELATIVE, ABSOLUTE = 1e-9, 1e-6
LOW = (1 << 32) - 1
_TABLE = "ids array<long>, x binary, near binary, upper binary, lower binary, moved array<struct<sum: long, radius: double>>, scanned long, own binary"


def integers(df: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and x: floor(scale * component) of the vectors that take part."""
    v = df.select(df[id_col].cast("long").alias("vec_id"), df[vec_col].cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * F.lit(float(scale)), F.lit(float(-MOST))), F.lit(float(MOST)))))
    return v.where((F.size("v") == dims) & fine).select("vec_id", whole.alias("x"))


def starts(x: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest hash of salt and id, in order; at most k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = x.select(key.alias("key"), "x").orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def loosened(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """An upper bound of |z - old| - |z - new| over all z of the sphere, at most the drift |new - old|.

    The points where the difference exceeds 2a times half the drift lie inside one branch of a hyperbola with
    foci old and new, and so inside its asymptotes' cone around the ray from the midpoint towards new, of half
    angle phi with cos(phi) = a. A sphere seen from the midpoint at the angle theta to that ray, and whose tangent
    takes asin(radius / distance), misses every cone of phi up to theta minus that angle.
    """
    axis = new - old
    drift = float(np.sqrt(axis @ axis))
    if not drift:
        return 0.0
    seen = centre - (old + new) / 2
    far = float(np.sqrt(seen @ seen))
    if far <= radius:
        return drift
    theta = float(np.arccos(np.clip(seen @ axis / (far * drift), -1.0, 1.0)))
    phi = theta - float(np.arcsin(radius / far))
    return drift * min(1.0, max(0.0, float(np.cos(max(phi, 0.0))) + RELATIVE))


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per cluster: what its upper bounds gain, what its lower bounds lose, and half the distance to the nearest other centroid."""
    k = len(old)
    a, b = old.astype(float), new.astype(float)
    gain = np.sqrt(((b - a) ** 2).sum(axis=1))
    loss = np.array([max((loosened(a[c], radius[c], a[j], b[j]) for j in range(k) if j != c), default=0.0) for c in range(k)])
    apart = np.sqrt(((b[:, None, :] - b[None]) ** 2).sum(axis=2))
    apart[np.arange(k), np.arange(k)] = np.inf
    return gain, loss, apart.min(axis=1) / 2


def _square(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", d, d)


def _packed(x: DataFrame) -> DataFrame:
    """The vectors in pieces, without a state; components of 16 bits if a piece's allow it, else of 32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, PIECE):
                part = batch.slice(row, PIECE)
                value = np.asarray(part.column(1).flatten(), dtype=np.int64)
                width = "<i2" if np.abs(value).max() < 1 << 15 else "<i4"
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([value.astype(width).tobytes()], pa.binary())], names=["ids", "x"])

    return x.mapInArrow(run, "ids array<long>, x binary")


def _assigned(table: DataFrame, centre: np.ndarray, moves: tuple[np.ndarray, np.ndarray, np.ndarray] | None, last: bool) -> DataFrame:
    """The table of the next round: every vector at its nearest centroid; ``own`` holds the exact distances, in the last round only."""
    k, dims = centre.shape

    def scan(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = np.stack([_square(x, c) for c in centre], axis=1)
        near = d.argmin(axis=1)
        first = d[np.arange(len(x)), near]
        d[np.arange(len(x)), near] = np.iinfo(np.int64).max
        return near, np.sqrt(first), np.sqrt(d.min(axis=1)) if k > 1 else np.full(len(x), np.inf)

    def place(row: dict) -> tuple:
        n = len(row["ids"])
        raw = row["x"]
        x = np.frombuffer(raw, dtype=f"<i{len(raw) // (n * dims)}").reshape(n, dims)
        if moves is None:
            before = np.full(n, -1)
            near, upper, lower = scan(x)
            scanned = n
        else:
            gain, loss, half = moves
            before = np.frombuffer(row["near"], dtype="<i4")
            near = before.copy()
            upper = np.frombuffer(row["upper"], dtype="<f8") + gain[before]
            lower = np.maximum(np.frombuffer(row["lower"], dtype="<f8") - loss[before], 0)
            sure = np.maximum(lower, half[before])
            open_ = np.flatnonzero(upper * (1 + RELATIVE) + ABSOLUTE >= sure)
            upper[open_] = np.sqrt(_square(x[open_], centre[before[open_]]))
            open_ = open_[upper[open_] * (1 + RELATIVE) + ABSOLUTE >= sure[open_]]
            near[open_], upper[open_], lower[open_] = scan(x[open_])
            scanned = len(open_)
        sums = np.zeros((k, dims + 1), np.int64)
        changed = near != before
        for c in range(k):
            for sign, some in ((1, changed & (near == c)), (-1, changed & (before == c))):
                if some.any():
                    sums[c, :dims] += sign * x[some].sum(axis=0, dtype=np.int64)
                    sums[c, dims] += sign * int(some.sum())
        radius = [float(upper[near == c].max()) if (near == c).any() else 0.0 for c in range(k)]
        own = _square(x, centre[near]) if last else np.zeros(0, np.int64)
        if last:
            sums[:] = 0
            sums[:, 0] = [int((own[near == c] & LOW).sum()) for c in range(k)]
            sums[:, 1] = [int((own[near == c] >> 32).sum()) for c in range(k)]
        moved = [{"sum": s, "radius": radius[c // (dims + 1)]} for c, s in enumerate(sums.ravel().tolist())]
        return row["ids"], raw, near.astype("<i4").tobytes(), upper.astype("<f8").tobytes(), lower.astype("<f8").tobytes(), moved, scanned, own.astype("<i8").tobytes()

    schema = pa.schema([("ids", pa.list_(pa.int64())), ("x", pa.binary()), ("near", pa.binary()), ("upper", pa.binary()), ("lower", pa.binary()), ("moved", pa.list_(pa.struct([("sum", pa.int64()), ("radius", pa.float64())]))), ("scanned", pa.int64()), ("own", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_ in range(batch.num_rows):
                out = place(batch.slice(k_, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return table.mapInArrow(run, _TABLE)


def _gathered(table: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of the changes (k x (dims + 1)), radius of each cluster, vectors scanned in full: k x (dims + 1) rows for the driver."""
    each = table.select(F.posexplode("moved").alias("pos", "m"), "scanned")
    rows = each.groupBy("pos").agg(F.sum("m.sum").alias("sum"), F.max("m.radius").alias("radius"), F.sum("scanned").alias("scanned")).collect()
    sums, radius = np.zeros(k * (dims + 1), np.int64), np.zeros(k * (dims + 1))
    for r in rows:
        sums[r["pos"]], radius[r["pos"]] = r["sum"], r["radius"]
    return sums.reshape(k, dims + 1), radius.reshape(k, dims + 1)[:, 0], rows[0]["scanned"] if rows else 0


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3:", id_col: str = "vec_id", vec_col: str = "embedding", report: list[dict] | None = None) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    ``rounds`` times every vector goes to its nearest centroid and every centroid that has vectors to the floor of
    their mean; then they are assigned once more. ``report``, if given, receives a row per round: vectors scanned in full.
    """
    x = integers(df, dims, scale, id_col, vec_col)
    with scratch(df.sparkSession):
        centre = starts(x, k, salt)
        if not len(centre):
            return x.selectExpr("vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256").where("false")
        k = len(centre)
        total, moves, table = np.zeros((k, dims + 1), np.int64), None, _packed(x)
        for at in range(rounds + 1):
            last = at == rounds
            path = shared_dir(df.sparkSession)
            _assigned(table, centre, moves, last).write.parquet(path)
            if at:
                delete(df.sparkSession, before)
            before, table = path, df.sparkSession.read.schema(_TABLE).parquet(path)
            sums, radius, scanned = _gathered(table, k, dims)
            if report is not None:
                report.append({"round": at, "scanned": scanned})
            if not last:
                total += sums
                some = total[:, dims] > 0
                new = centre.copy()
                new[some] = total[some, :dims] // total[some, dims :]
                moves, centre = loosening(centre, new, radius), new
        result = kept(_rows(table))
    inertia = [low + (high << 32) for low, high in sums[:, :2].tolist()]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre.tolist()]

    def of_cluster(values: list[Column]) -> Column:
        return F.array(*values)[F.col("cluster")]

    return result.select("vec_id", "cluster", "distance", of_cluster([_long(v) for v in inertia]).alias("cluster_inertia"), _long(sum(inertia)).alias("inertia"), of_cluster([F.lit(d) for d in digest]).alias("centroid_sha256"))


def _long(value: int) -> Column:
    return F.lit(value if value < 1 << 63 else None).cast("long")


def _rows(table: DataFrame) -> DataFrame:
    """A row per vector of the last round's table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                near, own = np.frombuffer(r["near"], dtype="<i4"), np.frombuffer(r["own"], dtype="<i8")
                yield pa.RecordBatch.from_arrays([pa.array(r["ids"], pa.int64()), pa.array(near), pa.array(own)], names=["vec_id", "cluster", "distance"])

    return table.select("ids", "near", "own").mapInArrow(run, "vec_id long, cluster int, distance long")
