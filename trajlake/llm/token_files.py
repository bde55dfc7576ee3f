"""Flat token-id files: unsigned integers, 64-bit document offsets, memory-mapped on reading.

Documents are dealt by ranges of doc_id, as many as the texts' bytes ask for. Each task encodes its range in ascending order and writes
four files into the shared folder: ``.bin`` (ids, little-endian, 16 bits if the vocabulary allows,
else 32), ``.idx`` (n + 1 offsets in ids, int64), ``.doc`` (doc_ids, int64) and ``.nul`` (a byte per document, 1 if its
doc_id is null). Reading maps them into memory on a local store; on any other it reads ranges, some thousand documents at a time. The manifest holds one
row per file; a partition's base is the exclusive prefix sum of the ids of those before it. File
names are unique per attempt and only those in the manifest count, so lost tasks may run again.

Cases: a null or empty text is a document with the end id alone; a null doc_id comes first;
repeated doc_ids stay apart, ordered by text; an empty table gives an empty manifest and result.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm.blocks import partitions_for
from trajlake.llm.text import LARGE_PIECE_BYTES, pieces
from trajlake.llm.tokens import text_ids
from trajlake.llm.workspace import documents, shared_dir

MANIFEST = "part int, file string, width int, docs long, tokens long"


#: Text bytes of a range, and documents that are read at a time.
RANGE_BYTES, DOCUMENTS = 64 << 20, 4096


class Mapped:
    """A file of numbers of one kind: mapped into memory if it is local, else read by ranges."""

    def __init__(self, store: fs.FileSystem, path: str, kind: str):
        self.kind = np.dtype(kind)
        self.local = isinstance(store, fs.LocalFileSystem)
        self.file = np.memmap(path, dtype=kind, mode="r") if self.local else store.open_input_file(path)
        self.size = len(self.file) if self.local else self.file.size() // self.kind.itemsize

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, some: slice) -> np.ndarray:
        if self.local:
            return np.asarray(self.file[some])
        a, b, _ = some.indices(self.size)
        return np.frombuffer(self.file.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize), dtype=self.kind)


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write(df: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, path: str | None = None, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; return the manifest (part, file, width, docs, tokens), itself kept as Parquet."""
    spark = df.sparkSession
    root = path or shared_dir(spark)
    width = 2 if vocabulary <= 1 << 16 else 4
    docs = documents(df, id_col, text_col)
    parts = partitions or partitions_for(df, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, RANGE_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(root)
        store.create_dir(folder, recursive=True)
        name = f"{folder}/{uuid.uuid4().hex}"
        docs = tokens = 0
        out = {}
        for piece in pieces(batches, limit=LARGE_PIECE_BYTES):
            if not out:
                out = {kind: store.open_output_stream(f"{name}.{kind}") for kind in ("bin", "idx", "doc", "nul")}
                out["idx"].write(np.zeros(1, "<i8").tobytes())
            ids, bounds = text_ids(piece.column(1), tokenizer_path, "words")
            n = piece.num_rows
            closed = np.full(len(ids) + n, end_id, dtype=f"<u{width}")
            closed[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))] = ids
            out["bin"].write(closed.tobytes())
            out["idx"].write((tokens + bounds[1:] + np.arange(1, n + 1)).astype("<i8").tobytes())
            out["doc"].write(piece.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            out["nul"].write(piece.column(0).is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes())
            docs += n
            tokens += len(closed)
        for stream in out.values():
            stream.close()
        if docs:
            part = TaskContext.get().partitionId() if TaskContext.get() else 0
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([os.path.basename(name)]), pa.array([width], pa.int32()), pa.array([docs]), pa.array([tokens])], names=["part", "file", "width", "docs", "tokens"])

    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest").withColumn("root", F.lit(root))


def bases(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``: ids in all files before. It has one row per file, so the sum is small."""
    rows = sorted((r for r in manifest.collect()), key=lambda r: r["part"])
    base, out = 0, []
    for r in rows:
        out.append((r["root"], r["file"], r["width"], base))
        base += r["tokens"]
    return manifest.sparkSession.createDataFrame(out, "root string, file string, width int, base long")


def read(spark: SparkSession, based: DataFrame) -> DataFrame:
    """Per document from the files alone: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, folder = _place(r["root"])
                ids, at, doc, null = (Mapped(store, f"{folder}/{r['file']}.{end}", kind) for end, kind in (("bin", f"<u{r['width']}"), ("idx", "<i8"), ("doc", "<i8"), ("nul", "u1")))
                for row in range(0, len(doc), DOCUMENTS):
                    edge = at[row : row + DOCUMENTS + 1]
                    own = doc[row : row + DOCUMENTS]
                    digest = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, mask=null[row : row + DOCUMENTS] > 0), pa.array(r["base"] + edge[:-1]), pa.array(np.diff(edge)), pa.array(digest, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return based.repartition(max(1, min(based.count(), 4096)), "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
