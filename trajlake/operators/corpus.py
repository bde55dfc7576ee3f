"""Seed corpora: duplicates, audits, policy gates, contamination, leakage and balanced samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.text import normalized_query
from trajlake.operators.similar_sets import near_pairs


def exact_duplicates(seeds: DataFrame) -> DataFrame:
    """Groups of more than one seed with one normalised query (a blank one groups too)."""
    keyed = seeds.select("seed_id", F.sha2(normalized_query(F.col("query")), 256).alias("query_hash"))
    return keyed.groupBy("query_hash").agg(F.count("*").alias("seeds"), F.min("seed_id").alias("first_seed"), F.max("seed_id").alias("last_seed")).where("seeds > 1")


#: Tokens whose frequencies are copied to every task, at most; the rarer ones count as equally rare.
KNOWN = 2_000_000


def semantic_duplicates(seeds: DataFrame, tenths: int = 8, known: int = KNOWN) -> DataFrame:
    """Pairs of token-set representatives with Jaccard of at least tenths / 10, found by rare-token prefixes.

    Copies follow their representative. Cases: no set is empty; one order for all sets is enough, so ``known`` changes the work only.
    """
    return near_pairs(seeds, tenths, known)


def dimension_counts(seeds: DataFrame, single: list[str], many: list[str]) -> DataFrame:
    """Counts of each value along several dimensions in one pass: dimension, value, seeds, trainable."""
    entries = [F.array(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"))) for c in single]

    def listed(name: str) -> Column:
        return F.transform(name, lambda v: F.struct(F.lit(name).alias("dimension"), v.alias("value")))

    entries += [listed(c) for c in many]
    flat = seeds.select("train_eligible", F.explode(F.concat(*entries)).alias("e")).select("train_eligible", "e.dimension", "e.value")
    return flat.groupBy("dimension", "value").agg(F.count("*").alias("seeds"), F.count(F.when(F.col("train_eligible"), 1)).alias("trainable"))


def audit_issues(seeds: DataFrame, accepted: dict[str, list[str]]) -> DataFrame:
    """One row per failed check of a seed: seed_id, code."""
    have = F.col("verifier_types")
    fits = F.lit(False)
    for family, kinds in accepted.items():
        fits = fits | ((F.col("task_family") == family) & F.arrays_overlap(have, F.array(*[F.lit(k) for k in kinds])))
    checks = F.array_compact(
        F.array(
            F.when(F.length(F.trim("query")) == 0, "empty_query"),
            F.when(F.col("language") == "", "missing_language"),
            F.when(F.size(have) == 0, "missing_verifier"),
            F.when(F.col("train_eligible") & ~fits, "family_verifier_mismatch"),
            F.when(F.col("train_eligible") & F.col("source_method").contains("benchmark"), "benchmark_marked_trainable"),
        )
    )
    return seeds.select("seed_id", F.explode(checks).alias("code"))


def policy_gates(seeds: DataFrame, minimum: int, most_share: dict[str, float]) -> DataFrame:
    """Failed gates over trainable seeds: too few, or a label's share above its cap (ties: first seed wins)."""
    train = seeds.where("train_eligible")
    total = train.agg(F.count("*").alias("total"))
    out = total.where(F.col("total") < minimum).select(F.lit("too_few_trainable").alias("code"), F.lit("").alias("label"), F.col("total").cast("double").alias("value"))
    for column, cap in most_share.items():
        counts = train.where(F.col(column) != "").groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"), F.min("seed_id").alias("first"))
        top = counts.orderBy(F.desc("n"), "first").limit(1)
        share = F.round(F.col("n") / F.col("total"), 6)
        out = out.unionByName(top.join(F.broadcast(total)).where(F.col("n") > cap * F.col("total")).select(F.lit(f"{column}_share").alias("code"), "label", share.alias("value")))
    return out


def dominance_gaps(seeds: DataFrame, column: str, cap: float) -> DataFrame:
    """Every label above the cap and the other rows needed to bring it there."""
    train = seeds.where("train_eligible")
    total = train.agg(F.count("*").alias("total"))
    counts = train.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(total)).where(F.col("n") > cap * F.col("total")).select("label", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"), (F.ceil(F.col("n") / cap) - F.col("total")).cast("long").alias("additional_rows"))


def minimum_gaps(counts: DataFrame, required: DataFrame) -> DataFrame:
    """Required labels that fall short; counts: dimension, value, trainable; required: dimension, value, minimum."""
    met = required.join(counts.select("dimension", "value", "trainable"), ["dimension", "value"], "left").withColumn("actual", F.coalesce("trainable", F.lit(0)))
    return met.where("actual < minimum").select("dimension", "value", "actual", "minimum", (F.col("minimum") - F.col("actual")).alias("gap"))


def family_gap(seeds: DataFrame, accepted: dict[str, list[str]]) -> DataFrame:
    """Trainable seeds per family, and how many have an accepted verifier."""
    fits = F.lit(False)
    for family, kinds in accepted.items():
        fits = fits | ((F.col("task_family") == family) & F.arrays_overlap("verifier_types", F.array(*[F.lit(k) for k in kinds])))
    return seeds.where("train_eligible").groupBy("task_family").agg(F.count("*").alias("trainable"), F.count(F.when(fits, 1)).alias("verified"))


def contamination(seeds: DataFrame, holdout: DataFrame, keys: dict[str, Column], warn_only: tuple[str, ...] = ()) -> DataFrame:
    """Matches of trainable seeds with holdout rows per kind of key: seed_id, kind, matches, severity.

    Blank keys never match and a seed never matches itself. Holdout rows are counted per key first, so
    that a common key is one row, not one per pair.
    """

    def keyed(df: DataFrame) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keys.items()])
        return df.select("seed_id", F.explode(entries).alias("e")).select("seed_id", "e.kind", "e.key").where("key <> ''")

    sides = keyed(holdout)
    totals = sides.groupBy("kind", "key").agg(F.count("*").alias("rows"))
    own = sides.select("seed_id", "kind", "key").withColumn("self", F.lit(1))
    met = keyed(seeds.where("train_eligible")).join(totals, ["kind", "key"]).join(own, ["seed_id", "kind", "key"], "left")
    severity = F.when(F.col("kind").isin(*warn_only), "warning").otherwise("error") if warn_only else F.lit("error")
    return met.select("seed_id", "kind", (F.col("rows") - F.coalesce("self", F.lit(0))).alias("matches"), severity.alias("severity")).where("matches > 0")


def key_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per left id: its distinct keys that another id on the right has, and the matches over them; both sides: id, key.

    The right side is counted per key before the join, so a common key stays one row.
    """
    other = right.distinct()
    counts = other.groupBy("key").agg(F.count("*").alias("ids"))
    met = left.distinct().join(counts, "key").join(other.select("id", "key", F.lit(1).alias("self")), ["id", "key"], "left")
    matches = F.col("ids") - F.coalesce("self", F.lit(0))
    return met.select("id", matches.alias("matches")).where("matches > 0").groupBy("id").agg(F.count("*").alias("overlap_keys"), F.sum("matches").alias("holdouts"))


def split_leakage(seeds: DataFrame, key: Column, left: str = "train", right: str = "evaluation") -> DataFrame:
    """Keys that occur in both splits: key_hash and the rows on each side."""
    sided = seeds.where(F.col("split").isin(left, right)).groupBy(F.sha2(key, 256).alias("key_hash"))
    counts = sided.agg(F.count(F.when(F.col("split") == left, 1)).alias("left_rows"), F.count(F.when(F.col("split") == right, 1)).alias("right_rows"))
    return counts.where("left_rows > 0 and right_rows > 0")


#: Characters of a word's part that a short value is sought by.
PART = 8
#: Characters of a piece of a long word; a substring is sought from the start of its string.
CHUNK = 256


# What a hidden value tells by itself: paths, 64 hex digits, and words that hold one of the markers.
PATHS, HEX_DIGITS, WORDS = "(?:[A-Za-z0-9_.-]+/)+[A-Za-z0-9_.-]+", "[0-9a-fA-F]{64,}", "[A-Za-z0-9_.-]{8,}"
MARKERS = ("hidden", "private", "secret", "evaluator")


def sensitive_fragments(values: DataFrame) -> DataFrame:
    """What in a hidden value tells it by itself, of 8 characters or more: value_id, value.

    These are paths and their base names, 64 hex digits on their own, and words with a marker in them.
    """
    paths = F.regexp_extract_all("value", F.lit(PATHS), 0)
    names = F.transform(paths, lambda p: F.substring_index(p, "/", -1))
    hashes = F.filter(F.regexp_extract_all("value", F.lit(HEX_DIGITS), 0), lambda h: F.length(h) == 64)
    marked = F.filter(F.regexp_extract_all("value", F.lit(WORDS), 0), lambda t: F.lower(t).rlike("|".join(MARKERS)))
    return values.select("value_id", F.explode(F.array_distinct(F.concat(paths, names, hashes, marked))).alias("value")).where(F.length("value") >= 8)


def passage_leaks(values: DataFrame, texts: DataFrame, gram: int = 8) -> DataFrame:
    """Texts that contain a value: value_id, text_id. Candidates share words with the value, then the whole is compared.

    values: value_id, value (an id may have several values); texts: text_id, text. Both are split at
    single spaces and line ends to find where a value may begin, so the join is by key; only those
    places are compared as strings. Values of fewer than gram + 2 words go by their rarest word.
    """
    values = values.withColumn("key", F.xxhash64("value_id", "value"))
    size = F.size(F.split("value", r"[ \n]"))
    head = F.slice(F.split("value", r"[ \n]"), 2, gram)  # whole words: the first may begin inside a word
    keyed = values.where(size >= gram + 2).select("key", F.xxhash64(head).alias("h"))
    words = texts.select("text_id", F.split("text", r"[ \n]").alias("w"))
    grams = words.where(F.size("w") >= gram).select("text_id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - gram + 1), lambda i: F.xxhash64(F.slice("w", i, gram))))).alias("h"))
    met = grams.join(keyed, "h").select("key", "text_id").union(_short_candidates(values.where(size < gram + 2), texts)).distinct()
    return met.join(values, "key").join(texts, "text_id").where(F.contains("text", "value")).select("value_id", "text_id")


def _short_candidates(values: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs that share the value's rarest word: key, text_id. values: key, value, of few words.

    Inside a value its words are whole; the first may end a word of the text, the last begin one, and an only
    one may stand anywhere in a word. Words of the texts are joined by their parts that such a word can have.
    """
    split = F.split("value", r"[ \n]")
    pieces = values.select("key", F.posexplode(split).alias("at", "piece"), F.size(split).alias("n")).where("piece <> ''")
    how = F.when(F.col("n") == 1, "in").when(F.col("at") == 0, "end").when(F.col("at") == F.col("n") - 1, "start").otherwise("whole")
    pieces = pieces.withColumn("how", how).withColumn("q", F.when(F.col("how") == "whole", 0).otherwise(F.least(F.length("piece"), F.lit(PART))))
    pieces = pieces.withColumn("part", F.expr("CASE how WHEN 'whole' THEN piece WHEN 'end' THEN right(piece, q) ELSE left(piece, q) END"))
    used = pieces.agg(F.collect_set(F.struct("how", "q")).alias("used")).where(F.size("used") > 0)  # one row at most
    words = texts.crossJoin(F.broadcast(used)).select("text_id", "used", F.explode(F.array_distinct(F.split("text", r"[ \n]"))).alias("word")).where("word <> ''")
    known = words.groupBy("word").agg(F.count("*").alias("df"), F.first("used").alias("used")).select("word", "df", F.explode("used").alias("u")).select("word", "df", "u.how", "u.q")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.length("word") - 1) / CHUNK)), lambda c: F.substring("word", (c * CHUNK + 1).cast("int"), F.lit(CHUNK + PART - 1)))
    inner = F.flatten(F.transform(chunks, lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - F.col("q") + 1, F.lit(1))), lambda i: F.substring(c, i, F.col("q")))))
    parts = F.when(F.col("how") == "in", F.array_distinct(inner)).otherwise(F.array(F.expr("CASE how WHEN 'whole' THEN word WHEN 'end' THEN right(word, q) ELSE left(word, q) END")))
    fits = "CASE how WHEN 'whole' THEN word = piece WHEN 'end' THEN endswith(word, piece) WHEN 'start' THEN startswith(word, piece) ELSE contains(word, piece) END"
    hits = known.select("word", "df", "how", "q", F.explode(parts).alias("part")).join(pieces, ["how", "q", "part"]).where(fits).select("key", "at", "word", "df")
    found = hits.groupBy("key", "at").agg(F.sum("df").alias("df")).groupBy("key").agg(F.count("*").alias("pieces"), F.min(F.struct("df", "at")).alias("best"))
    asked = pieces.groupBy("key").agg(F.countDistinct("at").alias("pieces"))  # a value with a word that no text has is nowhere
    anchors = found.join(asked, ["key", "pieces"]).select("key", F.col("best.at").alias("at")).join(hits, ["key", "at"]).select("key", "word").distinct()
    blank = values.where("translate(value, ' \\n', '') = ''")  # of separators alone: few that differ
    everywhere = texts.join(F.broadcast(blank.select("value").distinct()), F.contains("text", "value")).select("text_id", "value").join(blank, "value")
    return words.join(anchors, "word").select("key", "text_id").union(everywhere.select("key", "text_id"))


def stratified(rows: DataFrame, strata: list[str], order: str, per_stratum: int) -> DataFrame:
    """The first rows of every stratum."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*strata).orderBy(order))).where(F.col("rank") <= per_stratum)


def round_robin(rows: DataFrame, buckets: list[str], order: str, limit: int) -> DataFrame:
    """Rows taken in turn from each bucket (in order of bucket), keeping the order within, up to a limit."""
    ranked = rows.withColumn("turn", F.row_number().over(Window.partitionBy(*buckets).orderBy(order)))
    return ranked.where(F.col("turn") <= limit).orderBy("turn", *buckets).limit(limit)
