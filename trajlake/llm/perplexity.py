"""Quality classifier: perplexity under an interpolated modified Kneser-Ney byte n-gram model.

The model counts n-grams of UTF-8 bytes (order 5, key of 40 bits) of trusted documents. Discounts come
from the counts of counts of each order; every order's probabilities are joined to their contexts and to
the next lower order by key, all tables dealt by that key, down to a uniform base. The result is one table
of n-gram, log-probability for the n-grams that the corpus holds (backed off where trusted text lacks them).

Documents are scored by sharded count joins: each piece of documents sends its distinct n-grams to the
shards that hold their probabilities, and what comes back is summed by its own counts. Neither side is
copied to all tasks, and a common n-gram counts once a piece. A table of at most ``few`` n-grams (counted)
is one shard that fits every task: it is copied there instead, and the sums are the same to the last bit.
A language's threshold is a quantile of
the perplexities of its trusted documents that the model was not trained on (one in five, by a checksum of
doc_id), from a histogram of bounded size, times a margin. A few bytes say little, so the compared
perplexity takes in ``prior_bytes`` of the language's usual one.

Cases: a null or empty text has no perplexity and is rejected; a null language is a language of its
own ("und"); a language with fewer than ``least`` held-out trusted documents takes the threshold of all;
with fewer of all languages together, all trusted documents are learned from and judged by; a document labelled twice takes the
smaller label; a document at its threshold is kept; without trusted documents nothing can be judged and
every text is kept; repeated rows get equal results; carried columns may have any names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trajlake.llm.blocks import U, deal, gathered, packed, partitions_for, runs, unpacked
from trajlake.llm.text import SMALL_PIECE_BYTES, mix, pieces, release, utf8
from trajlake.llm.workspace import kept, scratch, written

ORDER = 5
#: Ids of trusted documents that may be copied to every task.
FEW_IDS = 2_000_000
#: N-grams of a table that may be copied to every task (12 bytes each).
FEW_NGRAMS = 8_000_000
#: N-grams of a shard, and bytes that its pieces send to it at once.
SHARD_NGRAMS, SHARD_BYTES = 500_000, 32 << 20
#: One trusted document in so many is not learned from; thresholds come from these.
HELD_OUT = 5
STEP = 0.005  # width of the histogram's bins, in log perplexity


def keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each text (zeros stand before a text) and the offsets of texts."""
    data, off = utf8(column)
    n = len(data)
    wide = np.concatenate([np.zeros(ORDER - 1, np.int64), data.astype(np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(ORDER):
        key = (key << 8) | wide[k : k + n]
    some = off[:-1][np.diff(off) > 0]
    for k in range(ORDER - 1):  # bytes of the text before do not count
        at = some + k
        inside = at < np.append(some[1:], n)
        key[at[inside]] &= (1 << (8 * (k + 1))) - 1
    return key, off


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """doc_id of documents whose (smallest) label is 1."""
    marks = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].alias("mark")).where("doc_id is not null and mark is not null")
    return marks.groupBy("doc_id").agg(F.min("mark").alias("mark")).where("mark = 1").select("doc_id", F.lit(True).alias("trusted"))


def with_trust(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Documents with a flag; the ids are copied to every task only if they are few."""
    known = written(trusted)
    known = F.broadcast(known) if known.count() <= FEW_IDS else known
    return docs.join(known, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))


def count_ngrams(docs: DataFrame) -> DataFrame:
    """gram and c, its count in the texts to learn from, for every n-gram of the corpus; docs: text, learn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held), pa.array(total)], names=["gram", "c"])

        for piece in pieces(batches):
            key, off = keys_of(piece.column(0))
            good = np.repeat(piece.column(1).to_numpy(zero_copy_only=False).astype(bool), np.diff(off))
            code, distinct = pd.factorize(key)
            both, at = np.unique(np.concatenate([held, distinct]), return_inverse=True)
            count = np.zeros(len(both), np.int64)
            np.add.at(count, at, np.concatenate([total, np.bincount(code[good], minlength=len(distinct))]))
            held, total = both, count
            if len(held) > 3_000_000:
                yield flush()
                held, total = held[:0], total[:0]
        if len(held):
            yield flush()

    return docs.select("text", "learn").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, own) with the discounted share of each n-gram in its context, and (context, spare) with what is left."""
    of = counts.where("c between 1 and 4").groupBy("c").agg(F.count("*").alias("n")).collect()
    n = {r["c"]: r["n"] for r in of}
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    cut = [min(max(d, 0.05), k) for k, d in ((1, 1 - 2 * y * n2 / n1 if n1 else 0.5), (2, 2 - 3 * y * n3 / n2 if n2 else 1.0), (3, 3 - 4 * y * n4 / n3 if n3 else 1.5))]
    discount = F.when(F.col("c") == 1, cut[0]).when(F.col("c") == 2, cut[1]).otherwise(cut[2])
    context = F.shiftright("gram", 8)
    whole = counts.withColumn("context", context).groupBy("context").agg(F.sum("c").alias("whole"), F.sum(discount).alias("loose"))
    own = counts.withColumn("context", context).join(whole, "context").select("gram", ((F.col("c") - discount) / F.col("whole")).alias("own"))
    return own, whole.select("context", (F.col("loose") / F.col("whole")).alias("spare"))


def probabilities(grams: DataFrame) -> DataFrame:
    """gram and logp for each n-gram of ``grams`` (gram, c); c > 0 in trusted text."""
    rows = grams.count()
    levels = {ORDER: grams.where("c > 0").select("gram", "c")}
    for k in range(ORDER - 1, 0, -1):  # a lower order counts the different bytes seen before
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1)).alias("gram")
        levels[k] = written(levels[k + 1].select(suffix).groupBy("gram").agg(F.count("*").alias("c")), rows)
    wanted = {ORDER: grams.select("gram")}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = wanted[k + 1].select(F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1)).alias("gram")).distinct()
    lower = None
    for k in range(1, ORDER + 1):
        own, spare = _discounted(levels[k])
        asked = wanted[k].select("gram", F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1)).alias("suffix"))
        asked = asked.join(own, "gram", "left").join(spare, "context", "left")
        base = asked.withColumn("p", F.lit(1 / 256)) if lower is None else asked.join(lower.withColumnRenamed("gram", "suffix"), "suffix")
        lower = written(base.select("gram", (F.coalesce("own", F.lit(0.0)) + F.coalesce("spare", F.lit(1.0)) * F.col("p")).alias("p")), rows)
    return lower.select("gram", F.log("p").cast("float").alias("logp"))


def _asked(column: pa.ChunkedArray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of a piece by shard and value, their shards, the place of each byte's n-gram among them, and the texts' offsets."""
    key, off = keys_of(column)
    code, distinct = pd.factorize(key)
    shard = (mix(distinct.view(U)) % U(shards)).astype(np.int64)
    order = np.lexsort((distinct, shard))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], shard[order], place[code], off


def _perplexities(logp: np.ndarray, place: np.ndarray, off: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Bytes and perplexity of each text, from its n-grams' places in ``logp``."""
    size = np.diff(off)
    some = np.flatnonzero(size)
    sums = np.zeros(len(size))
    if len(some):
        sums[some] = np.add.reduceat(logp.astype(np.float64)[place], off[:-1][some])
    return pa.array(size), pa.array(np.exp(-sums / np.maximum(size, 1)), mask=size == 0)


def score(docs: DataFrame, table: DataFrame, columns: list[str], few: int | None = None) -> DataFrame:
    """The named columns of all documents, n_bytes and perplexity (null without text); docs: text and the columns."""
    n = table.count()
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = "".join(f"{c} {kinds[c]}, " for c in columns) + "n_bytes long, perplexity double"
    if n > (FEW_NGRAMS if few is None else few):
        return _joined(packed(docs.select(*dict.fromkeys(["text", *columns]))), table, n, columns, schema)
    rows = table.select("gram", "logp").toArrow().sort_by("gram")
    shared = docs.sparkSession.sparkContext.broadcast((rows["gram"].to_numpy(), rows["logp"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, logp = shared.value
        for piece in pieces(batches, limit=SMALL_PIECE_BYTES):
            key, off = keys_of(piece.column(0))
            code, distinct = pd.factorize(key)
            yield pa.RecordBatch.from_arrays([*piece.columns[1:], *_perplexities(logp[np.searchsorted(gram, distinct)], code, off)], names=[*columns, "n_bytes", "perplexity"])

    own = docs.select("text", *[F.col(c).alias(f"s_{k}") for k, c in enumerate(columns)])
    return own.mapInArrow(run, schema)


def _joined(store: DataFrame, table: DataFrame, n: int, columns: list[str], schema: str) -> DataFrame:
    """Scores by sharded count joins; store: pieces of documents."""
    count = store.count()
    shards = max(1, -(-n // SHARD_NGRAMS))
    parts = max(1, -(-count * min(n, 1_000_000) * 4 // (shards * SHARD_BYTES)))  # a shard with many pieces stands several times
    held, slots = partitions_for(store, count, 16), partitions_for(store, shards * parts, 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                gram, shard, _, _ = _asked(unpacked(batch, row)["text"], shards)
                piece = batch["piece"][row].as_py()
                first, size = runs(shard)
                sent = [pa.compress(np.diff(gram[a : a + c], prepend=0).tobytes(), codec="zstd", asbytes=True) for a, c in zip(first.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard[first] * parts + piece % parts), pa.array(shard[first]), pa.array(np.full(len(first), piece)), pa.array(size), pa.array(sent, pa.binary())], names=["slot", "shard", "piece", "n", "gram"])
                release()

    def stand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, logp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            shard = (mix(gram.view(U)) % U(shards)).astype(np.int64)
            for k in range(parts if len(gram) else 0):
                out = deal(shard * parts + k, [gram, logp], ["gram", "logp"])
                yield pa.RecordBatch.from_arrays([out.column(0).cast(pa.int64()), out.column(1), out.column(2)], names=["slot", "gram", "logp"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        gram, logp = gathered(known, "gram", np.int64), gathered(known, "logp", np.float32)
        order = np.argsort(gram)
        gram, logp = gram[order], logp[order]
        out = []
        for size, raw in zip(asked["n"].to_pylist(), asked["gram"].to_pylist(), strict=True):
            wanted = np.cumsum(np.frombuffer(pa.decompress(raw, decompressed_size=8 * size, codec="zstd", asbytes=True), np.int64))
            out.append(logp[np.searchsorted(gram, wanted)].tobytes())
        return pa.table({"piece": asked["piece"], "shard": asked["shard"], "logp": pa.array(out, pa.binary())})

    nothing = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def total(docs_of: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs_of.num_rows:
            return nothing
        docs = unpacked(docs_of)
        _, _, place, off = _asked(docs["text"], shards)
        size, perplexity = _perplexities(gathered(answers.sort_by("shard"), "logp", np.float32), place, off)
        release()
        return pa.table({**{c: docs[c] for c in columns}, "n_bytes": size, "perplexity": perplexity})

    asks = store.mapInArrow(ask, "slot long, shard long, piece long, n long, gram binary")
    stands = table.select("gram", "logp").mapInArrow(stand, "slot long, gram binary, logp binary")
    answers = asks.repartition(slots, "slot").groupBy("slot").cogroup(stands.repartition(slots, "slot").groupBy("slot")).applyInArrow(answer, "piece long, shard long, logp binary")
    return store.repartition(held, "piece").groupBy("piece").cogroup(answers.repartition(held, "piece").groupBy("piece")).applyInArrow(total, schema)


def thresholds(scored: DataFrame, quantile: float, margin: float, least: int) -> DataFrame:
    """lang and threshold; scored: lang, judge (rows to take), perplexity. lang null holds the threshold of all languages."""
    binned = scored.where("judge and perplexity is not null").groupBy("lang", F.floor(F.log("perplexity") / STEP).alias("bin")).agg(F.count("*").alias("n"))
    sides = binned.unionByName(binned.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "bin", "n"))
    listed = sides.groupBy("lang").agg(F.sum("n").alias("all"), F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"))  # at most some thousand bins
    reached = F.aggregate(
        "bins",
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("bin")),
        lambda acc, b: F.struct((acc["sum"] + b["n"]).alias("sum"), F.coalesce(acc["bin"], F.when(acc["sum"] + b["n"] >= quantile * F.col("all"), b["bin"])).alias("bin")),
    )["bin"]
    return listed.where((F.col("all") >= least) | F.col("lang").isNull()).select("lang", (F.exp((reached + 1) * STEP) * margin).alias("threshold"))


def _by_language(values: dict[str, float], otherwise: float | None) -> Column:
    """A language's value, one condition per language, else the other."""
    out = F.lit(otherwise).cast("double")
    for name, value in values.items():
        out = F.when(F.col("lang") == name, F.lit(value)).otherwise(out)
    return out


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: list[str] | None = None, quantile: float = 0.99, margin: float = 1.1, least: int = 100, prior_bytes: int = 64) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, threshold, adjusted and kept; with ``carry`` only these columns of the kept documents."""
    carried = carry or []
    names = [f"c_{i}" for i in range(len(carried))]
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"), F.coalesce(df[lang_col].cast("string"), F.lit("und")).alias("lang"), *[df[c].alias(n) for c, n in zip(carried, names, strict=True) if c != text_col])
    flagged = with_trust(docs, trusted_ids(labels))
    apart = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0
    if flagged.where(F.col("trusted") & apart).count() < least:
        apart = F.lit(False)
    flagged = flagged.withColumn("learn", F.col("trusted") & ~apart)
    with scratch(df.sparkSession):
        table = kept(probabilities(written(count_ngrams(flagged))))
    scored = written(score(flagged, table, ["doc_id", "lang", "trusted", "learn"]))
    known = scored.where("trusted and perplexity is not null")
    usual = {r["lang"]: r["m"] for r in known.groupBy("lang").agg((F.sum(F.col("n_bytes") * F.log("perplexity")) / F.sum("n_bytes")).alias("m")).collect()}  # one row per language
    shrunk = F.exp((F.col("n_bytes") * F.log("perplexity") + prior_bytes * _by_language(usual, sum(usual.values()) / len(usual) if usual else None)) / (F.col("n_bytes") + prior_bytes))
    judges = F.col("trusted") & ~F.col("learn") if known.where("not learn").count() >= least else F.col("trusted")
    limits = {r["lang"]: r["threshold"] for r in thresholds(scored.select("lang", judges.alias("judge"), shrunk.alias("perplexity")), quantile, margin, least).collect()}
    limit = _by_language({k: v for k, v in limits.items() if k is not None}, limits.get(None))
    fine = F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (shrunk <= F.col("threshold")))
    if carry is None:
        return scored.withColumn("threshold", limit).select("doc_id", "lang", "n_bytes", "perplexity", "threshold", shrunk.alias("adjusted"), fine.alias("kept"))
    own = ["text" if c == text_col else n for c, n in zip(carried, names, strict=True)]
    again = score(docs, table, list(dict.fromkeys(["lang", *own]))).withColumn("threshold", limit)
    return again.where(fine).select(*[F.col(n).alias(c) for n, c in zip(own, carried, strict=True)])
