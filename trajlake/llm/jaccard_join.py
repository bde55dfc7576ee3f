"""Exact n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

1. Every document becomes its set of distinct word n-gram hashes; documents with equal sets are one
   class, known by a fingerprint of the set.
2. The incidence is dealt by n-gram hash. A shard finds the n-grams that more than one class has, with
   their document frequency, and sends these back by class. A class that shares fewer than the
   threshold's part of its n-grams has no partner and is done (size bound).
3. Of the others the rarest n-grams, just enough that two linked classes must share one, form the
   candidate graph; its components hold every possible pair.
4. Each component is a block of the product: rows are accumulated into overlap counts, pairs below the
   bound that their sizes set are discarded, and a block ends as soon as all its classes are one
   component. A large component meets its few hubs first; what these do not join is multiplied with all
   others in pairs of bounded blocks.
5. Links join classes to components; copies follow their class.

N-grams and sets are known by 64-bit hashes of their words. Cases: a null or empty text has an empty set, no link and its own id as component; fewer words than n
count as one n-gram; repeated rows are equal documents; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.blocks import U, components, deal, gathered, runs, shards_of
from trajlake.llm.components import connected
from trajlake.llm.text import lower_ascii, mix, pieces, span_hash, utf8, window_hash, words
from trajlake.llm.workspace import documents, kept, scratch, written

_RUN = U(0x9E3779B97F4A7C15)


def sets_of(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all texts, in order of text and hash; each text's offsets in them; each set's fingerprint."""
    data, off = utf8(column)
    texts = len(off) - 1
    data = lower_ascii(data)
    start, end, text = words(data, off)
    word = span_hash(data, start, end)
    gram = window_hash(word, n)
    of = text[: len(gram)]
    whole = of == text[n - 1 :] if len(gram) else np.zeros(0, bool)
    gram, of = gram[whole], of[whole]
    count = np.bincount(text, minlength=texts)
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        first = (np.cumsum(count) - count)[few]
        short = np.zeros(len(few), U)
        for k in range(n - 1):
            some = count[few] > k
            short[some] = mix(short[some] * _RUN + word[first[some] + k])
        gram, of = np.concatenate([gram, mix(short + count[few].astype(U))]), np.concatenate([of, few])
    order = np.argsort(gram, kind="stable")
    order = order[np.argsort(of[order].astype(np.uint32), kind="stable")]
    gram, of = gram[order], of[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (of[1:] != of[:-1])
    gram, of = gram[new], of[new]
    size = np.bincount(of, minlength=texts)
    bounds = np.concatenate([[0], np.cumsum(size)])
    print_of = np.zeros(texts, U)
    some = np.flatnonzero(size)
    if len(some):
        print_of[some] = mix(np.add.reduceat(mix(gram ^ _RUN), bounds[some]) + size[some].astype(U) * _RUN)
    return gram, bounds, print_of


def classes(df: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles and fp (null for an empty set) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            _, bounds, fp = sets_of(piece.column(1), n)
            size = np.diff(bounds)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(size), pa.array(fp.view(np.int64), mask=size == 0)], names=["doc_id", "n_shingles", "fp"])

    return df.mapInArrow(run, "doc_id long, n_shingles long, fp long")


def shared_ngrams(df: DataFrame, n: int, need: int, size: int) -> DataFrame:
    """Classes that may have a partner: fp, n, grams (those of more than one class) and prefix, as bytes.

    ``need`` is the threshold in hundredths, ``size`` the bytes of all texts: a shard's n-grams fit memory.
    """
    shards = shards_of(df, 2 * size)

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            gram, bounds, fp = sets_of(piece.column(1), n)
            size = np.diff(bounds)
            row = np.repeat(np.arange(len(size)), size)
            once = np.zeros(len(size), bool)  # a class goes once a piece, however many copies stand in it
            once[np.unique(fp, return_index=True)[1]] = True
            row, gram = row[once[row]], gram[once[row]]
            shard = ((gram >> U(32)) % U(shards)).astype(np.int64)
            order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
            row, shard, gram = row[order], shard[order], gram[order]
            # per shard the classes with their numbers of n-grams, then the n-grams
            first, count = runs(shard * len(size) + row)
            classed = deal(shard[first], [fp[row[first]], size[row[first]].astype(np.int32), count.astype(np.int32)], ["fp", "n", "count"])
            if classed is not None:
                grams = deal(shard, [gram], ["gram"])
                yield pa.RecordBatch.from_arrays([*classed.columns, grams.column(1)], names=["shard", "fp", "n", "count", "gram"])

    def common(table: pa.Table) -> pa.Table:
        """N-grams of more than one class, with their document frequency, dealt by class."""
        count = gathered(table, "count", np.int32)
        fp, size = np.repeat(gathered(table, "fp", U), count), np.repeat(gathered(table, "n", np.int32), count)
        gram = gathered(table, "gram", U)
        order = np.argsort(gram, kind="stable")
        first, count = runs(gram[order])
        order = order[np.repeat(count > 1, count)]
        order = order[np.lexsort((fp[order], gram[order]))]
        gram, fp, size = gram[order], fp[order], size[order]
        new = np.ones(len(gram), bool)  # a class counts once, however many documents it has
        new[1:] = (gram[1:] != gram[:-1]) | (fp[1:] != fp[:-1])
        gram, fp, size = gram[new], fp[new], size[new]
        first, count = runs(gram)
        frequency = np.repeat(count, count)
        some = frequency > 1
        out = deal((fp[some] % U(shards)).astype(np.int64), [fp[some], size[some], gram[some], frequency[some].astype(np.int32)], ["fp", "n", "gram", "df"])
        return pa.Table.from_batches([out]) if out is not None else pa.table({"shard": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("fp", "n", "gram", "df")}})

    def survivors(table: pa.Table) -> pa.Table:
        fp, size, gram, frequency = (gathered(table, c, k) for c, k in (("fp", U), ("n", np.int32), ("gram", U), ("df", np.int32)))
        order = np.lexsort((gram, frequency, fp))
        fp, size, gram = fp[order], size[order], gram[order]
        first, count = runs(fp)
        rows = []
        for a, c in zip(first.tolist(), count.tolist(), strict=True):
            total = int(size[a])
            if 100 * c >= need * total:
                prefix = total - (need * total + 99) // 100 + 1 - (total - c)
                rows.append((int(fp[a].astype(np.int64)), total, gram[a : a + c].tobytes(), gram[a : a + prefix].tobytes()))
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["fp", "n", "grams", "prefix"])

    block = "shard int, fp binary, n binary, gram binary, df binary"
    dealt = df.mapInArrow(incidence, "shard int, fp binary, n binary, count binary, gram binary")
    back = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(common, block)
    return back.repartition(shards, "shard").groupBy("shard").applyInArrow(survivors, "fp long, n int, grams binary, prefix binary")


def candidate_components(found: DataFrame) -> DataFrame:
    """fp and root of the classes that share a prefix n-gram with another, directly or through others."""
    shards = max(4, shards_of(found, 2 * (found.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0)) // 4)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = [np.frombuffer(x, U) for x in batch.column(1).to_pylist()]
                fp = np.repeat(batch.column(0).to_numpy(), [len(p) for p in parts])
                gram = np.concatenate(parts)
                out = deal(((gram >> U(32)) % U(shards)).astype(np.int64), [gram, fp], ["gram", "fp"])
                if out is not None:
                    yield out

    def star(table: pa.Table) -> pa.Table:
        gram, fp = gathered(table, "gram", U), gathered(table, "fp", np.int64)
        node, at = np.unique(fp, return_inverse=True)
        order = np.argsort(gram, kind="stable")
        first, count = runs(gram[order])
        hub = np.repeat(order[first], count)
        root = components(at[order], at[hub], len(node))
        tied = np.flatnonzero(root != np.arange(len(node)))
        return pa.table({"a": pa.array(node[tied]), "b": pa.array(node[root[tied]])})

    edges = found.select("fp", "prefix").mapInArrow(spread, "shard int, gram binary, fp binary").groupBy("shard").applyInArrow(star, "a long, b long")
    return connected(edges).select(F.col("node").alias("fp"), "root")


def product(sizes: np.ndarray, sets: list[np.ndarray], need: int, known: np.ndarray | None = None, rows: np.ndarray | None = None) -> np.ndarray:
    """Component (as the place of a member) of each class of a block, from the overlaps of its sets.

    known: labels of classes already joined; rows: places whose row of the product is wanted (else all).
    """
    m = len(sets)
    label = np.arange(m) if known is None else known.copy()
    left = len(np.unique(label))
    if left < 2:
        return label
    length = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), length)
    order = np.argsort(column, kind="stable")
    holders, edge = owner[order], np.concatenate([[0], np.cumsum(np.bincount(column))])
    start = np.concatenate([[0], np.cumsum(length)])
    wanted = np.arange(m) if rows is None else rows
    for i in wanted[np.argsort((sizes - length)[wanted], kind="stable")].tolist():  # those with the least of their own first
        if left == 1:
            break
        own = column[start[i] : start[i + 1]]
        met = np.concatenate([holders[edge[c] : edge[c + 1]] for c in own.tolist()])
        overlap = np.bincount(met, minlength=m)
        linked = np.flatnonzero((overlap > 0) & (100 * overlap >= need * (sizes[i] + sizes - overlap)))
        linked = np.unique(label[linked])
        if len(linked) > 1:
            label[np.isin(label, linked)] = linked[0]
            left -= len(linked) - 1
    return label


def _multiply(need: int):
    """Edges of one block; rows with ``whole`` false only stand against the others."""

    def run(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy()
        known = np.unique(table["label"].to_numpy(), return_index=True, return_inverse=True)
        first = known[1][known[2]]  # the first member with the same label
        rows = np.flatnonzero(table["whole"].to_numpy(zero_copy_only=False))
        label = product(table["n"].to_numpy().astype(np.int64), [np.frombuffer(x, U) for x in table["grams"].to_pylist()], need, first, rows)
        tied = np.flatnonzero(label != first)
        return pa.table({"a": pa.array(fp[tied]), "b": pa.array(fp[label[tied]])})

    return run


def _against_hubs(need: int):
    """Edges between the classes of a large component and its hubs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for r in batch.to_pylist():
                own = np.frombuffer(r["grams"], U)
                for h in r["hubs"]:
                    if h["fp"] != r["fp"]:
                        overlap = int(np.isin(own, np.frombuffer(h["grams"], U)).sum())
                        if overlap and 100 * overlap >= need * (r["n"] + h["n"] - overlap):
                            a.append(r["fp"])
                            b.append(h["fp"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def links(found: DataFrame, rooted: DataFrame, need: int, most: int = 250_000, hubs: int = 8) -> DataFrame:
    """Edges (a, b) between classes whose components are those of all links.

    A component of at most ``most`` n-grams is one block. A larger one is first held against a few
    hubs, its classes with the least of their own: copies of one text nearly all meet there. Of the rest
    each is held against all others in pairs of bounded blocks, so the work grows with the rest and not
    with the square of the component.
    """
    members = written(found.join(rooted, "fp").select("fp", "n", "grams", "root"))
    count = F.octet_length("grams") / 8
    size = members.groupBy("root").agg(F.sum(count).alias("all"))
    large = written(size.where(F.col("all") > most).select("root"))
    block = "a long, b long"
    small = members.join(large, "root", "left_anti").withColumn("label", F.col("fp")).withColumn("whole", F.lit(True))
    edges = small.groupBy("root").applyInArrow(_multiply(need), block)
    if large.isEmpty():
        return edges
    big = written(members.join(large, "root"))
    slot = F.pmod(F.xxhash64("fp"), F.lit(hubs))
    picked = big.groupBy("root", slot.alias("slot")).agg(F.min_by(F.struct("fp", "n", "grams"), F.struct(F.col("n") - count, "fp")).alias("hub"))
    central = written(picked.groupBy("root").agg(F.collect_list("hub").alias("hubs")))  # at most ``hubs`` a component
    met = written(big.join(F.broadcast(central) if central.count() <= 1000 else central, "root").select("fp", "n", "grams", "hubs").mapInArrow(_against_hubs(need), block))
    labels = connected(met).select(F.col("node").alias("fp"), F.col("root").alias("label"))
    labelled = written(big.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    shares = labelled.groupBy("root", "label").agg(F.sum(count).alias("grams"))
    mass = shares.groupBy("root").agg(F.max_by("label", F.struct("grams", "label")).alias("mass"), F.max("grams").alias("held"), F.sum("grams").alias("all"))
    blocks = mass.select("root", "mass", F.ceil(2 * F.col("held") / most).cast("int").alias("wide"), F.ceil(2 * (F.col("all") - F.col("held")) / most).cast("int").alias("rest")).where("rest > 0")
    placed = labelled.join(blocks, "root").withColumn("whole", F.col("label") != F.col("mass"))
    place = F.pmod(F.xxhash64("fp"), F.when(F.col("whole"), F.col("rest")).otherwise(F.col("wide"))).cast("int")
    placed = placed.withColumn("place", place)
    columns = ["fp", "n", "grams", "root", "label", "whole"]
    over = [
        placed.where("not whole").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rest") - 1))).select(*columns, "i", F.concat(F.lit("m"), F.col("place")).alias("j")),
        placed.where("whole").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("wide") - 1))).select(*columns, F.col("place").alias("i"), F.concat(F.lit("m"), F.col("j")).alias("j")),
        placed.where("whole").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("rest") - 1))).select(*columns, F.least("place", "o").alias("i"), F.concat(F.lit("r"), F.greatest("place", "o")).alias("j")),
    ]
    crossed = over[0].unionByName(over[1]).unionByName(over[2]).groupBy("root", "i", "j").applyInArrow(_multiply(need), block)
    return edges.unionByName(met).unionByName(crossed)


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.75) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    need = round(100 * threshold)
    docs = documents(df, id_col, text_col)
    classed = written(classes(docs, n))
    with scratch(df.sparkSession):
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        found = written(shared_ngrams(docs, n, need, size))
        rooted = written(candidate_components(found))
        roots = connected(links(found, rooted, need))
        smallest = classed.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("own"))
        joined = smallest.join(roots.select(F.col("node").alias("fp"), "root"), "fp")
        least = joined.groupBy("root").agg(F.min("own").alias("least"))
        linked = joined.join(least, "root").select("fp", "least")
        final = kept(smallest.join(linked, "fp", "left").select("fp", F.coalesce("least", "own").alias("component")))
    return classed.join(final, "fp", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
