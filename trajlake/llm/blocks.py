"""Pieces of documents, and shuffles of packed rows: tasks send each shard one binary row per piece instead of a row per item."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trajlake.llm.text import pieces
from trajlake.llm.workspace import written

U = np.uint64


def shards_of(df: DataFrame, size: int = 0, each: int = 64 << 20) -> int:
    """As many shards as ``size`` bytes ask for, and as the session has shuffle partitions at least."""
    return max(4, partitions_for(df, size, each))


def partitions_for(df: DataFrame, items: int, each: int) -> int:
    """Partitions for so many items, ``each`` to a partition; at least the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-items // each))


def packed(docs: DataFrame) -> DataFrame:
    """piece and docs: some MB of documents (with a column text) as one compressed value, written to the shared folder.

    A piece's number is drawn once and stands in the written table, so later steps may run again at will.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as stream:
                stream.write_batch(piece)
            yield pa.RecordBatch.from_arrays([pa.array([int.from_bytes(os.urandom(7), "big")]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["piece", "docs"])

    return written(docs.mapInArrow(pack, "piece long, docs binary"))


def unpacked(table: pa.Table | pa.RecordBatch, row: int = 0) -> pa.Table:
    """The documents of a piece."""
    return pa.ipc.open_stream(table["docs"][row].as_py()).read_all().combine_chunks()


def deal(shard: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch | None:
    """One row per shard that occurs: its number and, as bytes, its part of each column in order."""
    if not len(shard):
        return None
    order = np.argsort(shard.astype(np.uint16) if shard.max() < 1 << 16 else shard, kind="stable")
    ordered = shard[order]
    cuts = np.flatnonzero(np.diff(ordered)) + 1
    first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(ordered)]])
    arrays = [pa.array(ordered[first].astype(np.int32))]
    for column in columns:
        raw = np.ascontiguousarray(column[order])
        width = raw.dtype.itemsize
        offsets = np.append(first, last[-1]) * width
        arrays.append(pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["shard", *names])


def gathered(table: pa.Table, name: str, kind: str) -> np.ndarray:
    """All rows' bytes of a column as one array."""
    return np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind)


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal values."""
    if not len(ordered):
        z = np.zeros(0, np.int64)
        return z, z
    first = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    return first, np.diff(np.append(first, len(ordered)))


def repeated(values: np.ndarray) -> np.ndarray:
    """Places, in order of value, whose value occurs more than once."""
    order = np.argsort(values, kind="stable")
    first, count = runs(values[order])
    return order[np.repeat(count > 1, count)]


def sliding(f: np.ufunc, a: np.ndarray, width: int) -> np.ndarray:
    """f over each ``width`` consecutive values (block prefixes and suffixes: two passes whatever the width)."""
    n = len(a)
    if n < width:
        return a[:0]
    padded = np.concatenate([a, np.repeat(a[-1:], -n % width)]).reshape(-1, width)
    prefix = f.accumulate(padded, axis=1).ravel()
    suffix = f.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(suffix[: n - width + 1], prefix[width - 1 : n])


def components(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of the component of each of n nodes, by minimum labels and pointer jumping."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            return label


def batches_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.to_batches()
