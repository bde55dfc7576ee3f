"""Token usage: totals of nested counters, decimal cost, ledger pairing and bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(kind: T.DataType, path: str = "") -> list[str]:
    """Dotted paths of the numbers in a nested struct."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in _leaves(f.dataType, f"{path}.{f.name}" if path else f.name)]
    return [path]


def totals(calls: DataFrame, column: str) -> DataFrame:
    """path and total of every counter of a nested usage column."""
    leaves = _leaves(calls.schema[column].dataType)
    sums = calls.agg(*[F.sum(F.col(f"{column}.{p}")).alias(f"s{i}") for i, p in enumerate(leaves)])
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.col(f"s{i}").alias("total")) for i, p in enumerate(leaves)]))
    return sums.select(pairs.alias("x")).select("x.path", F.coalesce("x.total", F.lit(0)).cast("long").alias("total"))


def cost_by_job(calls: DataFrame, uncached: str, cached: str, output: str) -> DataFrame:
    """Tokens and exact decimal cost of each job; prices are per million tokens. Cached never exceeds prompt."""
    hit = F.least("cached_tokens", "prompt_tokens")

    def priced(n: Column, price: str) -> Column:
        return n.cast("decimal(18,0)") * F.lit(price).cast("decimal(10,2)")

    cost = priced(F.col("prompt_tokens") - hit, uncached) + priced(hit, cached) + priced(F.col("completion_tokens"), output)
    return calls.groupBy("job_id").agg(
        F.count("*").alias("calls"),
        F.sum("prompt_tokens").cast("long").alias("prompt_tokens"),
        F.sum(hit).cast("long").alias("cached_tokens"),
        F.sum("completion_tokens").cast("long").alias("completion_tokens"),
        F.round(F.sum(cost).cast("decimal(30,2)").cast("double") / 1e6, 8).alias("cost_usd"),
    )


def ledger_audit(started: DataFrame, completed: DataFrame, also: list[str]) -> DataFrame:
    """Per job: calls started, completed and left open, repeated call indexes, tokens charged."""
    keys = ["job_id", "call_index", *also]
    paired = started.join(completed, keys, "left")
    return paired.groupBy("job_id").agg(
        F.count("*").alias("started"),
        F.count("tokens").alias("completed"),
        (F.count("*") - F.count("tokens")).alias("open_calls"),
        (F.count("*") - F.countDistinct("call_index")).alias("repeated_indexes"),
        F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("charged"),
    )


def bound_violations(calls: DataFrame, limit: int) -> DataFrame:
    """Calls whose token counts contradict each other or their limit, with the rules they break."""
    rules = F.array_compact(
        F.array(
            F.when(F.col("cached_tokens") > F.col("prompt_tokens"), "cached_exceeds_prompt"),
            F.when(F.col("prompt_tokens") + F.col("completion_tokens") > limit, "total_exceeds_limit"),
            F.when(F.col("completion_tokens") == 0, "no_output"),
        )
    )
    return calls.withColumn("rules", rules).where(F.size("rules") > 0).withColumn("violations", F.array_join("rules", ",")).drop("rules")


#: Names under which a usage record may count input, output, all tokens, and hold details of the input.
INPUT, OUTPUT, ALL, DETAILS = ("input_tokens", "prompt_tokens"), ("output_tokens", "completion_tokens"), ("total_tokens",), ("input_tokens_details", "prompt_tokens_details")


def priced(calls: DataFrame, raw: str, uncached: str, cached: str, output: str) -> DataFrame:
    """The calls with input_tokens, cached_tokens, output_tokens, an exact cost_usd (decimal) and error ("" where all fits).

    ``raw`` names a column of usage records as JSON text. Aliases of one count must agree; prices are per
    million tokens. The first rule that is broken is the error, and such a call has no counts and no cost.
    """
    v = calls.withColumn("_u", F.try_parse_json(raw))

    def there(name: str) -> Column:
        return F.expr(f"try_variant_get(_u, '$.{name}', 'variant') is not null")

    def count(name: str) -> Column:
        return F.expr(f"if(schema_of_variant(try_variant_get(_u, '$.{name}', 'variant')) = 'BIGINT', try_variant_get(_u, '$.{name}', 'bigint'), null)")

    def first(names: tuple[str, ...]) -> Column:
        return F.coalesce(*[count(n) for n in names])

    def differ(names: tuple[str, ...]) -> Column:
        return F.coalesce(count(names[0]) != count(names[1]), F.lit(False))

    counted = (*INPUT, *OUTPUT, *ALL, "prompt_cache_hit_tokens", "prompt_cache_miss_tokens", *[f"{d}.cached_tokens" for d in DETAILS])
    broken = F.lit(False)
    for name in counted:
        broken = broken | (there(name) & F.coalesce(count(name) < 0, F.lit(True)))
    hit, miss = (F.coalesce(count(f"prompt_cache_{k}_tokens"), F.lit(0)) for k in ("hit", "miss"))
    details = [F.expr(f"to_json(try_variant_get(_u, '$.{d}', 'variant'))") for d in DETAILS]
    detail = F.coalesce(*[count(f"{d}.cached_tokens") for d in DETAILS], F.lit(0))
    v = v.withColumns({"_hit": hit, "_miss": miss, "_detail": detail, "_in": F.coalesce(first(INPUT), F.when(there("prompt_cache_hit_tokens") | there("prompt_cache_miss_tokens"), hit + miss)), "_out": first(OUTPUT), "_all": first(ALL)})
    kept = F.when(F.col("_hit") > 0, F.col("_hit")).otherwise(F.col("_detail"))
    error = (
        F.when(F.col("_u").isNull() | (F.coalesce(F.size(F.json_object_keys(raw)), F.lit(0)) <= 0), "empty")
        .when(broken, "not_a_count")
        .when(differ(INPUT), "input_conflict")
        .when(F.col("_in").isNull(), "input_missing")
        .when(F.coalesce(details[0] != details[1], F.lit(False)), "details_conflict")
        .when((F.col("_hit") > 0) & (F.col("_detail") > 0) & (F.col("_hit") != F.col("_detail")), "cached_conflict")
        .when((F.col("_miss") > 0) & (F.col("_hit") + F.col("_miss") != F.col("_in")), "cache_does_not_add_up")
        .when(kept > F.col("_in"), "cached_above_input")
        .when(differ(OUTPUT), "output_conflict")
        .when(F.col("_out").isNull(), "output_missing")
        .when(F.coalesce(F.col("_all") != F.col("_in") + F.col("_out"), F.lit(False)), "total")
        .otherwise("")
    )
    v = v.withColumns({"error": error, "_kept": kept})
    fine = F.col("error") == ""

    def part(n: Column, price: str) -> Column:
        return n.cast("decimal(18,0)") * F.lit(price).cast("decimal(10,4)")

    cost = part(F.col("_in") - F.col("_kept"), uncached) + part(F.col("_kept"), cached) + part(F.col("_out"), output)
    shown = {"input_tokens": F.when(fine, F.col("_in")), "cached_tokens": F.when(fine, F.col("_kept")), "output_tokens": F.when(fine, F.col("_out")), "cost_usd": F.when(fine, (cost.cast("decimal(30,4)") * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(38,10)"))}
    return v.withColumns(shown).drop("_u", "_hit", "_miss", "_detail", "_in", "_out", "_all", "_kept")


def _json_leaves(calls: DataFrame, raw: str, depth: int) -> DataFrame:
    """The rows with ``l``: fields of the JSON object in ``raw`` at any depth as an array of path, kind and value; objects below ``depth`` stay whole.

    A record without nested objects is done after the first level; each level is a column of its own, so nothing is worked out twice.
    """

    def entries(v: Column, above: Column | None = None) -> Column:
        def one(e: Column) -> Column:
            path = e["key"] if above is None else F.concat(above, F.lit("."), e["key"])
            return F.struct(path.alias("path"), F.coalesce(F.schema_of_variant(e["value"]), F.lit("")).alias("kind"), e["value"].alias("v"))

        return F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string, variant>")), one)

    def nested(x: Column) -> Column:
        return x["kind"].startswith("OBJECT<") & (x["kind"] != "OBJECT<>")

    out = calls.withColumn("_u", F.try_parse_json(raw)).withColumn("l", entries(F.col("_u")))
    for _ in range(depth - 1):
        deeper = F.flatten(F.transform("l", lambda x: F.when(nested(x), entries(x["v"], x["path"])).otherwise(F.array(x))))
        out = out.withColumn("l", F.when(F.exists("l", nested), deeper).otherwise(F.col("l")))
    return out.drop("_u")


def nested_usage(calls: DataFrame, key: str, raw: str, depth: int = 6) -> tuple[DataFrame, DataFrame]:
    """Sums of nested usage records by ``key``: (key, path, total), and what cannot be summed: (key, path, code, n).

    ``raw`` names a column of JSON objects of whole numbers, nested up to ``depth``. Codes: empty (null, no object, or one without fields), negative, not_a_count (anything
    but a whole number, also an object nested deeper, or an empty one) and shape_conflict (a path that is a number in one record and an object in
    another of the same key); such values are in no total. Records are taken apart once, where they lie; one row a path, with the counts of
    all codes, is shuffled, and beside it one for each object that a path lies in.
    """
    rows = _json_leaves(calls.select(F.col(key).alias("key"), F.col(raw).alias("_raw")), "_raw", depth).select("key", "l")
    each = rows.select("key", F.explode_outer("l").alias("x")).select("key", F.col("x").isNull().alias("none"), F.coalesce("x.path", F.lit("")).alias("path"), F.col("x.kind").alias("kind"), F.try_variant_get("x.v", "$", "bigint").alias("value"))
    count = F.coalesce(F.col("kind") == "BIGINT", F.lit(False))
    good = count & (F.col("value") >= 0)

    def n(when: Column) -> Column:
        return F.count(F.when(when, 1))

    sums = each.groupBy("key", "path").agg(
        F.sum(F.when(good, F.col("value").cast("decimal(38,0)"))).alias("total"), n(good).alias("good"), n(F.col("none")).alias("empty"), n(count & (F.col("value") < 0)).alias("negative"), n(~F.col("none") & ~count).alias("not_a_count")
    )
    parts = F.split("path", "\\.")
    above = F.transform(F.slice(F.sequence(F.lit(0), F.size(parts) - 1), 2, F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "."))
    own = F.struct(F.col("path"), F.lit(False).alias("inner"), "total", "good", "empty", "negative", "not_a_count")
    blank = [F.lit(None).cast("decimal(38,0)").alias("total"), *[F.lit(0).cast("long").alias(c) for c in ("good", "empty", "negative", "not_a_count")]]
    placed = F.when(F.instr("path", ".") == 0, F.array(own)).otherwise(F.concat(F.array(own), F.transform(above, lambda p: F.struct(p.alias("path"), F.lit(True).alias("inner"), *blank))))
    flat = sums.select("key", F.explode(placed).alias("x")).select("key", "x.*")
    met = flat.groupBy("key", "path").agg(F.max("inner").alias("inner"), F.sum("total").alias("total"), *[F.sum(c).alias(c) for c in ("good", "empty", "negative", "not_a_count")])
    leaf = F.col("good") + F.col("negative") + F.col("not_a_count")
    totals_ = met.where(~F.col("inner") & (F.col("good") > 0)).select("key", "path", F.col("total").cast("long").alias("total"))
    codes = {"empty": F.col("empty"), "negative": F.col("negative"), "not_a_count": F.col("not_a_count"), "shape_conflict": F.when(F.col("inner"), leaf).otherwise(0)}
    faults = met.select("key", "path", F.explode(F.array(*[F.struct(F.lit(c).alias("code"), m.alias("n")) for c, m in codes.items()])).alias("x")).select("key", "path", "x.code", "x.n").where("n > 0")
    return totals_, faults
