"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Every document is tokenised whole and closed with an end id. Stretches of ``window`` ids become
sequences of their own; what remains of a document is cut to parts of at most ``part`` ids. Parts
are packed in groups of bounded size inside the task that made them: each part starts as a partial
partition of k windows with one of them filled, the two partial partitions of largest imbalance are
merged with their fillings in opposite order, and so on until one partition with near-equal windows
is left. If its fullest window exceeds the capacity, k rises and the group is packed again.

No shuffle, no shared state: a lost task is simply run again. Cases: a null or empty text is a
document of the end id alone; a very long text is cut; repeated rows are packed twice; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from trajlake.llm.text import SMALL_PIECE_BYTES, pieces
from trajlake.llm.tokens import text_ids
from trajlake.llm.workspace import documents

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Members of k windows with near-equal sums, by multiway largest differencing."""
    one, two = [], []  # children of the nodes made after the items: contents of merged windows
    n = len(sizes)
    heap = []
    for i, s in enumerate(sizes.tolist()):
        heap.append((-s, i, None, None))
    heapq.heapify(heap)
    serial = n

    def dense(entry):
        if entry[2] is not None:
            return entry[2], entry[3]
        fill, node = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        fill[0], node[0] = -entry[0], entry[1]
        return fill, node

    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        (fill, node), (fill_b, node_b) = dense(a), dense(b)
        fill, other = fill + fill_b[::-1], node_b[::-1]
        both = np.flatnonzero((node >= 0) & (other >= 0))
        node = np.where(node >= 0, node, other)
        if len(both):
            mine = a[3] if a[3] is not None else dense(a)[1]
            fresh = n + len(one) + np.arange(len(both))
            one.extend(mine[both].tolist())
            two.extend(other[both].tolist())
            node[both] = fresh
        order = np.argsort(-fill, kind="stable")
        fill, node = fill[order], node[order]
        heapq.heappush(heap, (-int(fill[0] - fill[-1]), serial, fill, node))
        serial += 1
    _, node = dense(heap[0])
    out = []
    for top in node.tolist():
        stack, members = [top] if top >= 0 else [], []
        while stack:
            x = stack.pop()
            if x < n:
                members.append(x)
            else:
                stack += [one[x - n], two[x - n]]
        out.append(members)
    return out


def windows(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Fewest near-equal windows within the capacity that differencing finds."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = differencing(sizes, k)
        if max(int(sizes[m].sum()) for m in found if m) <= capacity:
            return [m for m in found if m]
        k += max(1, k // 200)


def pack(df: DataFrame, tokenizer_path: str, window: int = 1024, part: int = 256, group: int = 1536, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``group`` parts at a time are packed together; the last group of a task may be smaller.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        made = 0
        held: list[tuple] = []  # parts that wait for a group

        def flush() -> list[tuple]:
            nonlocal made
            rows = []
            for members in windows(np.array([p[2] for p in held], dtype=np.int64), window):
                at = 0
                for m in sorted(members):
                    rows.append((*held[m], base + made, at))
                    at += held[m][2]
                made += 1
            held.clear()
            return rows

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

        for piece in pieces(batches, limit=SMALL_PIECE_BYTES):
            ids, bounds = text_ids(piece.column(1), tokenizer_path, "pattern")
            rows = []
            for doc, a, b in zip(piece.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = np.append(ids[a:b], end_id).astype("<u4")
                total, at = len(own), 0
                while at < total:
                    size = window if total - at >= window else min(part, total - at)
                    entry = (doc, at, size, zlib.crc32(own[at : at + size].tobytes()), total)
                    if size == window:
                        rows.append((*entry, base + made, 0))
                        made += 1
                    else:
                        held.append(entry)
                        if len(held) >= group:
                            rows += flush()
                    at += size
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of(flush())

    return documents(df, id_col, text_col).mapInArrow(run, SCHEMA)
