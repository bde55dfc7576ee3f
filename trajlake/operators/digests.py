"""SHA-256 over ordered lines of each key, for keys of any size.

Lines are sorted by ranges of key and order over all tasks; each range joins its lines to ordered runs, and the runs of a
key are hashed one after the other as they stream by. No list of a key's lines is ever held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of a run.
RUN_BYTES = 1 << 20


def ordered_digests(df: DataFrame, key: Column, order: Column, line: Column, joint: str = "\n", head: str = "", tail: str = "") -> DataFrame:
    """key, n and sha256 of ``head``, the lines in order with ``joint`` between them, and ``tail``.

    Cases: a null key or line takes no part; lines of equal order go by their text, repeated ones are all hashed; a key
    without lines has no row.
    """
    some = df.select(key.cast("string").alias("key"), order.alias("place"), line.alias("line")).where("key is not null and line is not null")
    ordered = some.repartitionByRange("key", "place").sortWithinPartitions("key", "place", "line")
    kinds = {f.name: f.dataType.simpleString() for f in ordered.schema.fields}
    schema = f"key string, first {kinds['place']}, serial long, n long, text string"
    arrow = to_arrow_schema(ordered.sparkSession.createDataFrame([], schema).schema)
    size = RUN_BYTES

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first, held, total, serial = None, None, [], 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((own, first, serial, len(held), joint.join(held)), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for k, place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (k != own or total >= size):
                    yield flush()
                    held, total, serial = [], 0, serial + 1
                if not held:
                    own, first = k, place
                held.append(text)
                total += len(text)
        if held:
            yield flush()

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n, digest = None, 0, None

        def done() -> pa.RecordBatch:
            digest.update(tail.encode())
            return pa.RecordBatch.from_arrays([pa.array([own]), pa.array([n]), pa.array([digest.hexdigest()])], names=["key", "n", "sha256"])

        for batch in batches:
            for k, many, text in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "text")), strict=True):
                if k != own or digest is None:
                    if digest:
                        yield done()
                    own, n, digest = k, 0, hashlib.sha256(head.encode())
                digest.update(((joint if n else "") + text).encode())
                n += many
        if digest:
            yield done()

    return ordered.mapInArrow(runs, schema).repartition("key").sortWithinPartitions("key", "first", "serial").mapInArrow(combined, "key string, n long, sha256 string")
