"""Ranked lexical search with the best position algorithm over impact lists.

``index`` turns documents into shards of some MB of text: a row holds, for each term (of a given vocabulary, or of
all), the shard's documents that have it and how often, besides every document's number of terms. Document
frequencies, the number of documents and of terms come from the shards by one aggregation, so impacts are those of the
whole corpus. ``search`` then goes over the shards once for a block of queries. In a shard each term's documents are
laid out by descending impact. For a query its lists are read in parallel from the top; a document met
for the first time is looked up in all other lists (direct access), which also marks its positions there. A
list's best position is the last one up to which all are marked, and the sum of the impacts at the best positions bounds
every document not met yet. It falls faster than the sum at the positions last read. Reading stops once the bound lies strictly
below the k-th score, so that equal scores are all met. A task carries the k best of each query from shard to
shard, and the bound of a shard's first positions alone passes over most later ones.

The queries' vocabulary and blocks are copied to every task up to ``BLOCK_BYTES`` of query text; more queries are searched block by block,
over an index of all terms.

Cases: a null or empty text has no term and is no hit; a query without a term, or whose terms no document has, has no
hits; repeated queries and repeated documents are rows of their own, each ranked; a null doc_id comes after all others of
the same score; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm.text import distinct_spans, lower_ascii, pieces, release, spans, utf8
from trajlake.llm.workspace import documents, kept, scratch, written

#: Text bytes of a shard.
SHARD_BYTES = 8 << 20
#: Bytes of query text that are copied to every task at a time.
BLOCK_BYTES = 8 << 20
#: The bytes of terms are digits, letters and all beyond ASCII.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_IN_TERM = np.array([TERM.match(bytes([b])) is not None for b in range(256)])
INDEX = "docs array<long>, length binary, terms array<binary>, df array<long>, doc binary, tf binary, n_docs long, n_terms long"


def terms_of(text: str | None) -> list[bytes]:
    """Terms of one text, only A-Z lower-cased."""
    return TERM.findall((text or "").encode().lower())


class _Shard:
    """Postings of the documents seen so far."""

    def __init__(self, wanted: frozenset[bytes] | None):
        self.wanted, self.code, self.docs = wanted, {}, []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.lengths: list[np.ndarray] = []
        self.bytes = 0

    def add(self, piece: pa.RecordBatch) -> None:
        data, off = utf8(piece.column(1))
        data = lower_ascii(data)
        start, end, text = spans(_IN_TERM[data], off)
        which, distinct = distinct_spans(data, start, end)
        take = [-1 if self.wanted is not None and t not in self.wanted else self.code.setdefault(t, len(self.code)) for t in distinct]
        code = np.array(take, np.int64)[which] if len(which) else which
        some = code >= 0
        key, tf = np.unique(code[some] * piece.num_rows + text[some], return_counts=True)
        self.parts.append(((key // piece.num_rows), key % piece.num_rows + len(self.docs), tf))
        self.docs += piece.column(0).to_pylist()
        self.lengths.append(np.bincount(text, minlength=piece.num_rows))
        self.bytes += len(data)

    def row(self) -> pa.RecordBatch:
        code, doc, tf = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        order = np.lexsort((doc, code))
        length = np.concatenate(self.lengths)
        values = [self.docs, length.astype("<i8").tobytes(), list(self.code), np.bincount(code, minlength=len(self.code)).tolist(), doc[order].astype("<i4").tobytes(), tf[order].astype("<i4").tobytes(), int((length > 0).sum()), int(length.sum())]
        kinds = [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in INDEX.split(", ")])


def index(df: DataFrame, vocabulary: frozenset[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards of the documents' postings, one a row; of all terms if no vocabulary is given."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(shared.value)
        for piece in pieces(batches):
            shard.add(piece)
            if shard.bytes >= SHARD_BYTES:
                yield shard.row()
                shard = _Shard(shared.value)
        if shard.docs:
            yield shard.row()

    return documents(df, id_col, text_col).mapInArrow(run, INDEX)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a term's score that depends on the document, in 64-bit integers."""
    wide = object if 75 * int(length.max(initial=0)) * n_docs >= 1 << 63 else np.int64
    m = (25 + (75 * length.astype(wide) * n_docs) // n_terms).astype(np.int64)
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


class _Lists:
    """Impact lists of a shard's terms, laid out when first asked for."""

    def __init__(self, row: dict, n_docs: int, n_terms: int, weights: dict[bytes, int]):
        self.doc, self.tf = np.frombuffer(row["doc"], "<i4"), np.frombuffer(row["tf"], "<i4")
        self.length = np.frombuffer(row["length"], "<i8")
        edge = np.concatenate([[0], np.cumsum(row["df"])]).tolist()
        self.span = {t: (a, b) for t, a, b in zip(row["terms"], edge[:-1], edge[1:], strict=True) if weights.get(t) and b > a}
        self.corpus, self.weights, self.known = (n_docs, n_terms), weights, {}

    def of(self, term: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents in their own order with their impacts; the places by descending impact, and each one's position there."""
        if term not in self.known:
            a, b = self.span[term]
            doc = self.doc[a:b]
            value = self.weights[term] * impacts(self.tf[a:b], self.length[doc], *self.corpus)
            order = np.argsort(-value, kind="stable")
            position = np.empty(len(order), np.int64)
            position[order] = np.arange(len(order))
            self.known[term] = doc, value, order, position
        return self.known[term]


#: A hit: minus its score, whether its id is null, and the id; so hits sort as they rank.
Hit = tuple[int, bool, int]


def best(lists: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], times: list[int], ids: list[int | None], k: int, found: list[Hit]) -> tuple[list[Hit], int]:
    """The k first of ``found`` and a shard's hits with a score above 0, and how many documents were looked up.

    ``lists`` are those of the query's terms, each counted ``times``; ``ids`` the ids of the shard's documents.
    """

    def least() -> int:
        return max(1, -found[k - 1][0]) if len(found) >= k else 1

    ends = [len(x[0]) for x in lists]
    met = np.zeros(len(ids), bool)
    marked = [np.zeros(e + 1, bool) for e in ends]  # the last one stays unmarked
    at = [0] * len(lists)  # best position: so many are marked from the top
    bound = sum(c * int(x[1][x[2][0]]) for x, c in zip(lists, times, strict=True))
    depth, step = 0, max(k, 8)
    while bound >= least():
        fresh = np.unique(np.concatenate([x[0][x[2][depth : depth + step]] for x in lists]))
        depth, step = depth + step, step * 2
        fresh = fresh[~met[fresh]]
        met[fresh] = True
        score = np.zeros(len(fresh), np.int64)
        for (doc, value, _, position), c, seen in zip(lists, times, marked, strict=True):  # direct access
            place = np.minimum(np.searchsorted(doc, fresh), len(doc) - 1)
            hit = doc[place] == fresh
            score[hit] += c * value[place[hit]]
            seen[position[place[hit]]] = True
        good = np.flatnonzero(score >= least())
        if len(good) > k:
            good = good[score[good] >= np.partition(score[good], -k)[-k]]
        if len(good):
            found = sorted([*found, *((-v, ids[d] is None, ids[d] or 0) for v, d in zip(score[good].tolist(), fresh[good].tolist(), strict=True))])[:k]
        bound = 0
        for j, ((_, value, order, _), c) in enumerate(zip(lists, times, strict=True)):
            at[j] += int(np.argmin(marked[j][at[j] :]))
            bound += c * int(value[order[at[j] - 1]]) if at[j] < ends[j] else 0
    return found, int(met.sum())


def _searched(shards: DataFrame, asked: list[tuple[int, dict[bytes, int]]], weights: dict[bytes, int], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """slot, doc_id and score: at most k hits of each query from each task."""
    shared = shards.sparkSession.sparkContext.broadcast((asked, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight_of = shared.value
        found: dict[int, list[Hit]] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                of = _Lists(row, n_docs, n_terms, weight_of)
                for slot, terms in queries:
                    held = [t for t in terms if t in of.span]
                    if held:
                        found[slot], _ = best([of.of(t) for t in held], [terms[t] for t in held], row["docs"], k, found.get(slot, []))
                release()
        flat = [(slot, None if null else d, -v) for slot, hits in found.items() for v, null, d in hits]
        yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in flat], pa.int64()) for j in range(3)], names=["slot", "doc_id", "score"])

    return shards.select("docs", "length", "terms", "df", "doc", "tf").mapInArrow(run, "slot long, doc_id long, score long")


def search_index(shards: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score: the k best documents of each row of ``queries`` with a score above 0."""
    spark = shards.sparkSession
    corpus = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("all")).first()
    n_docs, n_terms = corpus["n"] or 0, corpus["all"] or 0
    asked = queries.select(queries[id_col].cast("long").alias("item_id"), queries[text_col].cast("string").alias("text"))
    ranked: DataFrame | None = None
    for block in _blocks(asked):
        counts = [(slot, dict(zip(*np.unique(np.array(t, object), return_counts=True), strict=True))) for slot, (_, t) in enumerate(block) if t]
        counts = [(slot, {t: int(c) for t, c in x.items()}) for slot, x in counts]
        vocabulary = spark.createDataFrame([(t,) for t in {t for _, x in counts for t in x}], "term binary")
        each = shards.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.df").alias("df"))
        held = each.join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()  # at most the block's terms
        weights = {bytes(r["term"]): weight(n_docs, r["df"]) for r in held}
        top = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        hits = _searched(shards, counts, weights, n_docs, n_terms, k).withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(slot, item) for slot, (item, _) in enumerate(block)], "slot long, item_id long")
        part = hits.join(F.broadcast(names), "slot").select("item_id", "rank", "doc_id", "score")
        ranked = part if ranked is None else ranked.unionByName(part)
    return ranked if ranked is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _blocks(asked: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The queries with their terms, some MB of text at a time."""
    block, size = [], 0
    for r in asked.toLocalIterator():
        block.append((r["item_id"], terms_of(r["text"])))
        size += len(r["text"] or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """Like ``search_index``, over an index of the documents that holds the queries' terms only, if these are few."""
    size = queries.agg(F.sum(F.octet_length(queries[query_text_col].cast("string")))).first()[0] or 0
    few = size <= BLOCK_BYTES
    vocabulary = frozenset(t for r in queries.select(queries[query_text_col].cast("string").alias("t")).collect() for t in terms_of(r["t"])) if few else None
    with scratch(df.sparkSession):
        return kept(search_index(written(index(df, vocabulary, id_col, text_col)), queries, k, query_id_col, query_text_col))
