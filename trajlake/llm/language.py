"""Language identification by error-correcting output codes.

Each language has a codeword. For every bit a binary n-gram classifier (log-odds of hashed byte
4-grams of the case-folded letters, between the languages with that bit set and the others)
predicts the bit's value; decoding sums a loss per bit, weighted by how far that classifier tells its two sides
apart, and takes the nearest codeword. A small gap to the second codeword marks the document ambiguous.

Counts come from all training documents through one aggregation of at most languages x buckets
rows; that table, bounded whatever the input, is the model that tasks receive.

Cases: a null text or one without a letter gets ``und`` with score 0; repeated rows get equal
results; with no training document at all every document gets ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.text import pieces, utf8

BUCKETS = 1 << 14
_fold = np.full(256, 32, dtype=np.uint32)
_fold[97:123] = np.arange(97, 123)
_fold[65:91] = np.arange(97, 123)
_fold[128:] = np.arange(128, 256)
_ascii_letter = np.zeros(256, dtype=bool)
_ascii_letter[[*range(65, 91), *range(97, 123)]] = True


def _grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bucket of the 4-gram that begins at each byte; every text ends in spaces, so no byte of the next one is seen."""
    b = np.concatenate([_fold[data], np.full(3, 32, np.uint32)])
    n = len(data)
    key = b[:n].copy()
    for k in (1, 2, 3):
        ahead = b[k : n + k].copy()
        for back in range(1, k + 1):
            at = off[1:] - back
            ahead[at[at >= 0]] = 32
        key |= ahead << np.uint32(8 * k)
    return ((key * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def _has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_ascii_letter[data])])
    out = seen[off[1:]] > seen[off[:-1]]
    for k in np.flatnonzero(~out & (np.diff(off) > 0)).tolist():
        out[k] = regex.search(r"\p{L}", data[off[k] : off[k + 1]].tobytes().decode()) is not None
    return out


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray  # bits: mean distance of a classifier's two sides


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """All distinct two-way splits for up to five languages, else far-apart random ones."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 5:
        return np.array([[1 if i == 0 else -1 if (s >> (i - 1)) & 1 else 1 for s in range(1, 1 << (n - 1))] for i in range(n)], dtype=np.int8)
    bits = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        near = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)) if np.abs(code.sum(axis=0)).max() < n else -1
        if near > apart:
            best, apart = code, near
    return best


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", alpha: float = 0.5) -> Model | None:
    """Model of the bits from every row with a language and a text; no other column is looked at."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for piece in pieces(batches):
            data, off = utf8(piece.column(0))
            gram = _grams(data, off)
            lang = np.array(piece.column(1).to_pylist(), dtype=object)
            for name in set(lang.tolist()):
                of = np.repeat(lang == name, np.diff(off))
                total[name] = total.get(name, np.zeros(BUCKETS, np.int64)) + np.bincount(gram[of], minlength=BUCKETS)
        for name, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(counts[some])], names=["lang", "bucket", "n"])

    seen = labelled.select(labelled[text_col].alias("text"), labelled[lang_col].cast("string").alias("lang")).where("text is not null and lang is not null")
    rows = seen.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(rows):
        return None
    names = sorted(rows["lang"].unique())
    counts = np.zeros((len(names), BUCKETS))
    counts[[names.index(x) for x in rows["lang"]], rows["bucket"]] = rows["n"]
    counts /= counts.sum(axis=1, keepdims=True)  # a language counts as one, however many documents it has
    codes = codewords(len(names))
    weights, scale = np.zeros((BUCKETS, codes.shape[1])), np.ones(codes.shape[1])
    floor = alpha / 1e6
    for b in range(codes.shape[1]):
        p, q = counts[codes[:, b] > 0], counts[codes[:, b] < 0]
        if len(p) and len(q):
            p, q = p.mean(axis=0) + floor, q.mean(axis=0) + floor
            weights[:, b] = np.log(p) - np.log(q)
            scale[b] = max(1e-6, float(((p - q) * weights[:, b]).sum()) / 2)
    return Model(names, codes, weights.astype(np.float32), scale)


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", gap: float = 0.1, carry: list[str] | None = None) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), second, ambiguous; ``carry`` names columns to keep beside them."""
    carried = carry or []
    kept = [f"carry_{i}" for i in range(len(carried))]
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded: buckets x bits floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for piece in pieces(batches, limit=1 << 20):
            n = piece.num_rows
            data, off = utf8(piece.column(1))
            ok = _has_letter(data, off) if m else np.zeros(n, bool)
            length = np.diff(off)
            some = np.flatnonzero(length > 0)
            share = np.zeros((n, max(1, len(m.languages) if m else 1)))
            if len(some):
                gram = _grams(data, off) if m else None
                if m:
                    f = np.zeros((n, m.codes.shape[1]))
                    for b in range(m.codes.shape[1]):
                        f[some, b] = np.add.reduceat(m.weights[gram, b].astype(np.float64), off[:-1][some])
                    f[some] /= length[some, None]
                    unit = np.clip(f / m.scale, -3, 3)
                    loss = (np.exp(-unit[:, None, :] * m.codes[None]) * m.scale).sum(axis=2) / m.scale.sum()
                    share = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
                    share /= share.sum(axis=1, keepdims=True)
            order = np.argsort(-share, axis=1, kind="stable")
            best = share[np.arange(n), order[:, 0]]
            second = share[np.arange(n), order[:, 1]] if share.shape[1] > 1 else np.zeros(n)
            name = (m.languages if m else ["und"])
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([name[k] if y else "und" for k, y in zip(order[:, 0].tolist(), ok.tolist(), strict=True)]),
                    pa.array(np.where(ok, best, 0.0)),
                    pa.array([name[k] if y else None for k, y in zip(order[:, min(1, share.shape[1] - 1)].tolist(), ok.tolist(), strict=True)], pa.string()),
                    pa.array(~ok | (best - second < gap)),
                    *[piece.column(k) for k in range(2, 2 + len(kept))],
                ],
                names=["doc_id", "lang_pred", "score", "second", "ambiguous", *kept],
            )

    types = dict(df.dtypes)
    more = "".join(f", {k} {types[c]}" for k, c in zip(kept, carried, strict=True))
    base = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"), *[df[c].alias(k) for k, c in zip(kept, carried, strict=True)])
    named = base.mapInArrow(run, f"doc_id long, lang_pred string, score double, second string, ambiguous boolean{more}")
    return named.select("doc_id", "lang_pred", "score", "second", "ambiguous", *[F.col(k).alias(c) for k, c in zip(kept, carried, strict=True)])
