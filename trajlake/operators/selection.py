"""Greedy selections. Their state is a few counters, so only label combinations, or a bounded head of the rows, reach the driver.

While label combinations are few, each with the keys that it may give, they come to the driver once. Beyond that the choice is made
lazily: a choice never makes another row better, so a head of the rows in their present order is enough for as
long as its best row is not behind the first row left out; then the next head is drawn. Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Label combinations that a greedy choice may keep on the driver, and rows of a head where there are more.
MOST_COMBINATIONS, HEAD_ROWS = 200_000, 5_000


def _combinations(df: DataFrame, columns: list[str], *aggregates) -> list | None:
    """The combinations with their aggregates; None if they are more than may be kept."""
    found = df.groupBy(*columns).agg(*aggregates).limit(MOST_COMBINATIONS + 1).collect()
    return found if len(found) <= MOST_COMBINATIONS else None


def _lazily(pool: DataFrame, target: int, key: str, order: Callable[[], list[Column]], rank: Callable[[Row], tuple], open_: Callable[[], Column], fits: Callable[[Row], bool], take: Callable[[Row], None]) -> list:
    """Keys of up to ``target`` rows, one after the other the first by ``rank`` that ``fits``; both only ever get worse as rows are taken.

    ``order`` and ``open_`` say the same to Spark, for the state at the time of the call.
    """
    chosen: list = []
    held: list[Row] = []
    bound: tuple | None = ()
    while len(chosen) < target:
        best = min((r for r in held if fits(r)), key=rank, default=None)
        if bound is not None and (best is None or rank(best) > bound):
            left = pool.where(open_()).join(F.broadcast(pool.sparkSession.createDataFrame([(k,) for k in chosen], pool.select(key).schema)), key, "left_anti")  # at most ``target`` keys
            head = left.orderBy(*order()).limit(HEAD_ROWS + 1).collect()
            held, bound = head[:HEAD_ROWS], rank(head[HEAD_ROWS]) if len(head) > HEAD_ROWS else None
            continue
        if best is None:
            break
        held.remove(best)
        chosen.append(best[key])
        take(best)
    return chosen


def _per_value(column: str, values: dict, otherwise: float) -> Column:
    """A number by a column's value, for the values that rows taken so far have."""
    known = {v: n for v, n in values.items() if v is not None}
    out = F.lit(otherwise)
    if known:
        out = F.coalesce(F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[F.col(column)], out)
    return F.when(F.col(column).isNull(), F.lit(values[None])).otherwise(out) if None in values else out


def balanced(seeds: DataFrame, target: int, caps: dict[str, float], key: str = "seed_id") -> DataFrame:
    """Seeds chosen one by one: under every cap, least pressure first (in the order of the caps), then by key.

    Rows with the same labels are taken in order of key, so the choice is made on label combinations
    and the number that each gives; a window then takes that many rows of each.
    """
    columns = list(caps)
    ranked = seeds.withColumn("_n", F.row_number().over(Window.partitionBy(*columns).orderBy(key)))
    # of one combination no more than its tightest cap can be taken: only these keys matter for ties
    limits = {c: target if share >= 1 else math.floor(target * share) for c, share in caps.items()}
    most = max(0, min([target, *limits.values()]))
    heads = _combinations(ranked.where(F.col("_n") <= most), columns, F.sort_array(F.collect_list(key)).alias("keys")) if most else []
    counts: dict[str, Counter] = {c: Counter() for c in columns}
    if heads is None:
        capped = [c for c in columns if caps[c] < 1]

        def add(r: Row) -> None:
            for c in columns:
                counts[c][r[c]] += 1

        def order() -> list[Column]:
            return [_per_value(c, {v: n / max(1, limits[c]) for v, n in counts[c].items()}, 0.0) for c in capped] + [F.col(key)]

        def under() -> Column:
            full = [_per_value(c, {v: 1.0 for v, n in counts[c].items() if n + 1 > limits[c]}, 0.0) == 0 for c in capped]
            return F.lit(True) if not full else full[0] if len(full) == 1 else F.forall(F.array(*full), lambda x: x)

        keys = _lazily(
            ranked.where(F.col("_n") <= most).select(key, *columns), target, key, order, lambda r: (*[counts[c][r[c]] / max(1, limits[c]) for c in capped], r[key]), under,
            lambda r: all(counts[c][r[c]] + 1 <= limits[c] for c in capped), add,
        )
        return seeds.join(F.broadcast(seeds.sparkSession.createDataFrame([(k,) for k in keys], seeds.select(key).schema)), key).select(*seeds.columns)
    taken: Counter = Counter()
    waiting = {tuple(r[c] for c in columns): r["keys"] for r in heads}
    for _ in range(target):
        best = None
        for labels, keys in waiting.items():
            if taken[labels] >= len(keys) or any(caps[c] < 1 and counts[c][v] + 1 > limits[c] for c, v in zip(columns, labels, strict=True)):
                continue
            pressure = tuple(0.0 if caps[c] >= 1 else counts[c][v] / max(1, limits[c]) for c, v in zip(columns, labels, strict=True))
            rank = (*pressure, keys[taken[labels]])
            if best is None or rank < best[0]:
                best = (rank, labels)
        if best is None:
            break
        taken[best[1]] += 1
        for c, v in zip(columns, best[1], strict=True):
            counts[c][v] += 1
    chosen = [(*labels, n) for labels, n in taken.items()]
    kinds = dict(seeds.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", _take int"
    return ranked.join(F.broadcast(seeds.sparkSession.createDataFrame(chosen, schema)), columns).where(F.col("_n") <= F.col("_take")).drop("_n", "_take")


def covering(summaries: DataFrame, k: int, columns: list[str], critical: int = 1000) -> DataFrame:
    """Critical traces first, then one by one those that add the most unseen values (columns in order), by risk and id.

    Of each combination of values only its first k by (risk, id) can be chosen: these come to the driver.
    """
    order = Window.partitionBy(*columns).orderBy(F.desc("risk_score"), "trace_id")
    heads = _combinations(summaries.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k), columns, F.sort_array(F.collect_list(F.struct(-F.col("risk_score"), "trace_id"))).alias("heads"))
    if heads is None:
        return _covering_lazily(summaries, k, columns, critical)
    pool = [(tuple(r[c] for c in columns), -h[0], h[1]) for r in heads for h in r["heads"]]
    chosen = sorted((x for x in pool if x[1] >= critical), key=lambda x: (-x[1], x[2]))[:k]
    named = {x[2] for x in chosen}
    while len(chosen) < k and len(named) < len(pool):
        seen = [{x[0][i] for x in chosen} for i in range(len(columns))]
        best = min((x for x in pool if x[2] not in named), key=lambda x: (*[-(v not in seen[i]) for i, v in enumerate(x[0])], -x[1], x[2]))
        chosen.append(best)
        named.add(best[2])
    picked = summaries.sparkSession.createDataFrame([(x[2], n) for n, x in enumerate(chosen)], "trace_id string, position int")
    return summaries.join(F.broadcast(picked), "trace_id")


def _covering_lazily(summaries: DataFrame, k: int, columns: list[str], critical: int) -> DataFrame:
    rows = summaries.select("trace_id", "risk_score", *columns)
    first = [r for r in rows.where(F.col("risk_score") >= critical).orderBy(F.desc("risk_score"), "trace_id").limit(k).collect()]
    seen: dict[str, dict] = {c: {r[c]: 1.0 for r in first} for c in columns}

    def add(r: Row) -> None:
        for c in columns:
            seen[c][r[c]] = 1.0

    named = [r["trace_id"] for r in first]
    rest = rows.join(F.broadcast(summaries.sparkSession.createDataFrame([(t,) for t in named], summaries.select("trace_id").schema)), "trace_id", "left_anti")
    more = _lazily(
        rest, k - len(named), "trace_id", lambda: [*[_per_value(c, seen[c], 0.0) for c in columns], F.desc("risk_score"), F.col("trace_id")],
        lambda r: (*[seen[c].get(r[c], 0.0) for c in columns], -r["risk_score"], r["trace_id"]), lambda: F.lit(True), lambda r: True, add,
    )
    picked = summaries.sparkSession.createDataFrame([(t, n) for n, t in enumerate([*named, *more])], "trace_id string, position int")
    return summaries.join(F.broadcast(picked), "trace_id")


def reserved_slots(gaps: DataFrame, target: int, shared: tuple[str, ...] = ("verifier_types",)) -> DataFrame:
    """Slots to keep for missing labels and what is left for existing seeds.

    Gaps of single-label dimensions add up within a dimension; of dimensions that one seed may serve
    together only the largest counts; the largest dimension decides.
    """
    by = gaps.groupBy("dimension").agg(F.sum("gap").alias("sum"), F.max("gap").alias("most"))
    need = F.when(F.col("dimension").isin(*shared), F.col("most")).otherwise(F.col("sum"))
    reserved = F.coalesce(F.max(need), F.lit(0)).cast("long")
    return by.agg(reserved.alias("reserved")).select("reserved", F.greatest(F.lit(0), F.lit(target) - F.col("reserved")).cast("long").alias("existing_target"))
