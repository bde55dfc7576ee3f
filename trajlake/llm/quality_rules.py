"""Quality rules: text statistics in Spark SQL and a decision list learned from labelled ones.

The statistics and the verdict are DataFrame expressions only. Learning is sequential covering: the
labelled rows' statistics are cut at a few quantiles each, one aggregation counts labels per cell of
that grid (at most BINS**features cells whatever the input), and on these counts rules are grown
condition by condition by information gain on one part of the labelled rows, pruned on the other,
and kept while they stay precise. The ordered rules become one conditional expression.

Cases: a null text has no words (all statistics 0, base_failed); an empty or blank text too; very
long texts are taken whole; repeated rows get equal results; without labels of both kinds there is
no rule and the verdict is that of the base; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.llm.workspace import written

SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
#: Derived statistics that rules may test, as expressions over the columns of ``statistics``.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}
BINS = 8


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of whole texts."""
    base = df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    trimmed = F.btrim("text", F.lit(BLANK))
    plain = F.col("text")
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    worded = base.select(
        "doc_id",
        F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.octet_length("text") - F.octet_length(plain)).alias("n_symbols"),
    )
    windowed = worded.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= 5, F.transform(F.slice("words", F.lit(1), F.size("words") - 4), lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, 5)]))).alias("windows"),
    )
    repeated = windowed.withColumn("clean", F.coalesce(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(True)))
    # only texts with a repeated window are sorted: equal hashes lie side by side with their places
    paired = repeated.withColumn("pairs", F.when(~F.col("clean"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    places = paired.withColumn(
        "places",
        F.when(
            ~F.col("clean"),
            F.sort_array(
                F.transform(
                    F.filter(
                        F.transform("pairs", lambda p, k: F.struct(p["i"].alias("i"), (_same("pairs", p, k, -1) | _same("pairs", p, k, 1)).alias("twice"))),
                        lambda p: p["twice"],
                    ),
                    lambda p: p["i"],
                )
            ),
        ),
    )
    covered = F.aggregate(
        F.col("places"),
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-5).alias("last")),
        lambda acc, p: F.struct((acc["sum"] + F.least(F.lit(5), p - acc["last"])).cast("long").alias("sum"), p.alias("last")),
        lambda acc: acc["sum"],
    )
    return places.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _same(array: str, p: Column, k: Column, step: int) -> Column:
    """Whether the entry beside entry k has the same hash."""
    beside = F.get(F.col(array), k + step)
    return F.coalesce(beside["h"] == p["h"], F.lit(False))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Reject where all conditions (feature, ">" or "<=", threshold) hold."""

    conditions: tuple[tuple[str, str, float], ...]
    rejected: int
    wrong: int

    def column(self) -> Column:
        out = F.lit(True)
        for feature, sign, at in self.conditions:
            value = F.expr(FEATURES[feature])
            out = out & ((value > at) if sign == ">" else (value <= at))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{f} {s} {t:.6g}" for f, s, t in self.conditions) + f" -> reject ({self.rejected} bad, {self.wrong} good)"


def learn(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", precision: float = 0.97, most_rules: int = 12, most_conditions: int = 4) -> list[Rule]:
    """Decision list for label 0 from statistics that pass the base; a doc with two labels takes the smaller."""
    marks = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("_good")).where("_good is not null").groupBy("doc_id").agg(F.min("_good").alias("_good"))
    names = list(FEATURES)
    rows = stats.where(~base_failed()).join(marks, "doc_id").select("_good", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("_third"), *[F.expr(e).alias(f) for f, e in FEATURES.items()])
    shares = [0.02, 0.5, 0.98, 0.999]
    found = rows.groupBy("_good").agg(*[F.percentile_approx(f, shares, 2000).alias(f) for f in names]).where("_good in (0, 1)").collect()
    if len(found) < 2:
        return []
    cuts = {f: sorted({v for r in found for v in r[f] if v is not None})[: BINS - 1] for f in names}
    binned = rows.where("_good in (0, 1)").select(
        "_good",
        (F.col("_third") == 0).alias("_prune"),
        *[sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias(f) for f in names],
    )
    cells = binned.groupBy("_good", "_prune", *names).count().collect()  # bounded by the grid
    parts = {p: [(tuple(r[f] for f in names), r["_good"], r["count"]) for r in cells if r["_prune"] == p] for p in (False, True)}
    return _cover(parts[False], parts[True], cuts, names, precision, most_rules, most_conditions)


def _counts(cells: list, conditions: tuple, index: dict[str, int]) -> tuple[int, int]:
    """Bad and good rows under the conditions (feature, sign, cut number)."""
    bad = good = 0
    for at, label, n in cells:
        if all((at[index[f]] > c) == (s == ">") for f, s, c in conditions):
            if label:
                good += n
            else:
                bad += n
    return bad, good


def _cover(grow: list, prune: list, cuts: dict, names: list[str], precision: float, most_rules: int, most_conditions: int) -> list[Rule]:
    index = {f: k for k, f in enumerate(names)}
    literals = [(f, s, c) for f in names for c in range(len(cuts[f])) for s in (">", "<=")]
    rules: list[Rule] = []
    while len(rules) < most_rules:
        chosen: tuple = ()
        bad, good = _counts(grow, chosen, index)
        while good and bad and len(chosen) < most_conditions:
            best, gain, counts = None, 1e-9, None
            inside = [x for x in grow if all((x[0][index[f]] > c) == (s == ">") for f, s, c in chosen)]
            before = math.log2(bad / (bad + good))
            for lit in literals:
                b, g = _counts(inside, (lit,), index)
                if b and (g := b * (math.log2(b / (b + g)) - before)) > gain:
                    best, gain, counts = lit, g, _counts(inside, (lit,), index)
            if best is None:
                break
            chosen, (bad, good) = (*chosen, best), counts

        def worth(conditions: tuple) -> float:
            b, g = _counts(prune, conditions, index)
            return (b - g) / (b + g) if b + g else -1.0

        while len(chosen) > 1 and worth(chosen[:-1]) >= worth(chosen):
            chosen = chosen[:-1]
        held_bad, held_good = _counts(prune, chosen, index)
        seen_bad, seen_good = _counts(grow, chosen, index)
        if not chosen or not held_bad or held_bad < precision * (held_bad + held_good) or seen_bad < precision * (seen_bad + seen_good):
            break
        rules.append(Rule(tuple((f, s, cuts[f][c]) for f, s, c in chosen), held_bad + seen_bad, held_good + seen_good))

        def left(cells: list) -> list:
            return [x for x in cells if not all((x[0][index[f]] > c) == (s == ">") for f, s, c in chosen)]

        grow, prune = left(grow), left(prune)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True to keep: the first rule that holds decides, the default keeps."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), F.lit(False)) if out is None else out.when(rule.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of every document, base_failed and kept. The text is read once."""
    stats = written(statistics(df, id_col, text_col))
    rules = learn(stats, labels)
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))
