"""Byte-level BPE encoding and decoding by corpus merge replay.

Each task takes the distinct pre-tokens of its slice of the corpus, lays their bytes out as one
symbol array and keeps an inverted index from merge rank to symbol positions. Merges are applied
in rank order over the whole slice at once; a merge only touches the neighbours of the places
where it applies, and only the new pairs next to them enter the index. Encoded pre-tokens are kept
(bounded) for the following texts of the same worker. No shuffle is needed.

Cases: a null or empty text has no ids and decodes to empty bytes; texts of any length are encoded
whole; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trajlake.llm.text import LARGE_PIECE_BYTES, SpanCoder, per_text, pieces, pretokens, utf8
from trajlake.llm.workspace import documents


class MergeReplay:
    """Ranks of a vocabulary as a table of pairs, and their replay over many words at once."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        self.token = {int(rank): base64.b64decode(text) for text, rank in lines}
        rank_of = {text: rank for rank, text in self.token.items()}
        self.byte_id = np.array([rank_of[bytes([b])] for b in range(256)], dtype=np.int64)
        self.size = max(self.token) + 1
        pairs: dict[int, int] = {}
        risky = np.zeros(self.size, dtype=bool)
        for text, rank in rank_of.items():
            for cut in range(1, len(text)):
                left, right = rank_of.get(text[:cut]), rank_of.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
                    if rank < left:
                        risky[left] = True
                    if rank < right:
                        risky[right] = True
        order = sorted(pairs)
        self.pair = np.array(order, dtype=np.int64)
        self.merged = np.array([pairs[k] for k in order], dtype=np.int64)
        #: tokens that can take part in a merge of lower rank than their own
        self.risky = risky

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged[at], -1)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        length = np.array([len(w) for w in words], dtype=np.int64)
        symbol = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(symbol)
        word = np.repeat(np.arange(len(words)), length)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        last = np.cumsum(length)[length > 0] - 1
        after[last] = -1
        before[(last + 1)[:-1]] = -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Index the pairs that begin at these positions."""
            at = at[after[at] >= 0]
            rank = self._ranks(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, places in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(places)

        if n:
            enter(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = index.pop(r)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else np.sort(at[0])
            at = at[(symbol[at] >= 0) & (after[at] >= 0)]
            at = at[self._ranks(symbol[at], symbol[after[at]]) == r]
            if not len(at):
                continue
            if self.risky[r]:  # one place of a word at a time: its new pairs may come first
                _, first = np.unique(word[at], return_index=True)
                rest = np.ones(len(at), dtype=bool)
                rest[first] = False
                if rest.any():
                    index[r] = [at[rest]]
                    heapq.heappush(heap, r)
                at = at[first]
            else:
                touching = np.flatnonzero(after[at[:-1]] == at[1:])
                if len(touching):  # of overlapping places the leftmost goes first
                    keep = np.ones(len(at), dtype=bool)
                    for k in touching.tolist():
                        if keep[k]:
                            keep[k + 1] = False
                    at = at[keep]
            gone = after[at]
            symbol[at] = r
            symbol[gone] = -1
            after[at] = after[gone]
            follow = after[at]
            before[follow[follow >= 0]] = at[follow >= 0]
            left = before[at]
            enter(np.unique(np.concatenate([at, left[left >= 0]])))
        alive = symbol >= 0
        return symbol[alive].astype(np.uint32), np.bincount(word[alive], minlength=len(words)).astype(np.int64)


_loaded: dict[str, tuple[SpanCoder, MergeReplay]] = {}


def coder(path: str) -> tuple[SpanCoder, MergeReplay]:
    """One per worker process and vocabulary."""
    if path not in _loaded:
        replay = MergeReplay(path)
        _loaded[path] = SpanCoder(replay), replay
    return _loaded[path]


def encode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, _ = coder(ranks_path)
        for piece in pieces(batches, limit=LARGE_PIECE_BYTES):
            data, off = utf8(piece.column(1))
            start, end, text = pretokens(data, off)
            ids, count = code(data, start, end)
            bounds = per_text(count, text, piece.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([piece.column(0), lists], names=["doc_id", "ids"])

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and bytes (binary) of every list of ids; a null list decodes to empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, replay = coder(ranks_path)
        token = replay.token
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                texts = [b"".join(map(token.__getitem__, ids or [])) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], names=["doc_id", "bytes"])

    return df.select(df[id_col].cast("long").alias("doc_id"), df[ids_col].alias("ids")).mapInArrow(run, "doc_id long, bytes binary")


def round_trip(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the digests of its ids and of the bytes that these decode to, in one pass.

    Returns doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and
    decoded_sha256. Decoding reads nothing but the ids: token bytes are gathered by id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, replay = coder(ranks_path)
        size = np.zeros(replay.size, dtype=np.int64)
        for rank, text in replay.token.items():
            size[rank] = len(text)
        first = np.cumsum(size) - size
        table = np.frombuffer(b"".join(replay.token.get(k, b"") for k in range(replay.size)), dtype=np.uint8)
        for piece in pieces(batches, limit=LARGE_PIECE_BYTES):
            data, off = utf8(piece.column(1))
            start, end, text = pretokens(data, off)
            ids, count = code(data, start, end)
            bounds = per_text(count, text, piece.num_rows)
            width = size[ids]
            ends = np.concatenate([[0], np.cumsum(width)])
            plain = table[np.arange(int(ends[-1])) + np.repeat(first[ids] - ends[:-1], width)].tobytes()
            raw, edges = ids.astype("<u4").tobytes(), ends[bounds]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array(np.diff(bounds)),
                    pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]),
                    pa.array([hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(edges[:-1], edges[1:], strict=True)]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
