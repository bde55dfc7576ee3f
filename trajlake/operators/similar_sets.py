"""Exact Jaccard join of token sets by rare-token prefixes, whose groups of near sets are compared in blocks.

1. A query's distinct tokens (``[a-z0-9]+`` of the lower-cased text, not pure numbers) become 64-bit hashes; equal sets are one class,
   kept by its smallest seed.
2. Tokens are ordered by frequency, then hash. Two sets that share the tokens they must share one of the first n - share + 1 tokens
   of each. Each of these places carries its set's signature, whose bit b tells if the tokens with hash b are odd in number: it differs
   from another's in no more bits than the sets in tokens.
3. A token's places are sorted by set size, so that a set meets only those up to the size that can still be near. Of the pairs that size,
   places and signatures leave, the token passes on a spanning forest, not the pairs: copies of one text meet at every token.
4. The components of all forests hold every near pair. A component's texts are taken apart once more and compared, token by token,
   in pairs of bounded blocks.

Only steps 1 and 2 go by hashes; the tokens of pairs are compared themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.sources.shared import new_folder

U = np.uint64
#: 64-bit words of the signature of a set of up to NARROW tokens; each doubling of the tokens doubles them.
WORDS, NARROW = 8, 900
#: Bytes of text or hashes handled at a time, pairs of places compared at a time, sets of a block, and columns of a block's product.
PIECE, PAIRS, BLOCK, COLUMNS = 1 << 20, 500_000, 512, 8192

_LETTER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_DIGIT[ord("0") : ord("9") + 1] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = _mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


def _bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and the offsets of each; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def _sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of a column each; one longer value is a slice of its own."""
    for batch in batches:
        off, row = _bytes(batch.column(column))[1], 0
        while row < batch.num_rows:
            stop = min(max(int(np.searchsorted(off, off[row] + limit, "right")) - 1, row + 1), batch.num_rows)
            yield batch.slice(row, stop - row)
            row = stop


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens in a row, the length and the text number of each; no pure numbers."""
    letter = _LETTER[data]
    solid = letter | _DIGIT[data]
    edge = off[1:-1][off[1:-1] < len(data)]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    first[edge] = solid[edge]
    last[edge[edge > 0] - 1] = solid[edge[edge > 0] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    letters = np.concatenate([[0], np.cumsum(letter)])
    some = letters[end] > letters[start]
    start, length = start[some], (end - start)[some]
    before = np.cumsum(length) - length
    return data[np.arange(int(length.sum())) + np.repeat(start - before, length)], length, np.searchsorted(off, start, "right") - 1


def _hashes(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of each token; tokens stand in a row."""
    if not len(length):
        return np.zeros(0, U)
    before = np.cumsum(length) - length
    place = np.arange(len(data)) - np.repeat(before, length)
    key = _mix(np.arange(1, int(length.max()) + 1, dtype=U) * U(0xD1342543DE82EF95)) | U(1)
    return _mix(np.add.reduceat(_BYTE[data] * key[place], before) + length.astype(U) * U(0x9E3779B97F4A7C15))


def _written(df: DataFrame, folder: str) -> DataFrame:
    """Cut lineage: the table as files below a shared folder."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """seed_id, two fingerprints of the token set, its size and its hashes in order; no empty set."""
    for piece in _sliced(batches, "query"):
        data, off = _bytes(piece.column("query"))
        data, length, row = _tokens(data, off)
        h = _hashes(data, length)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
        rows, first = np.unique(row, return_index=True)
        if not len(rows):
            continue
        n = np.diff(np.append(first, len(h)))
        prints = [_mix(np.add.reduceat(_mix(h ^ U(k)), first) + n.astype(U)).view(np.int64) for k in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)]
        hashes = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(np.append(first, len(h)).astype(np.int64) * 8), pa.py_buffer(h)]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([piece.column("seed_id").take(pa.array(rows)), *[pa.array(p) for p in prints], pa.array(n.astype(np.int32)), hashes], ["seed_id", "fp", "fp2", "n", "hashes"])


def token_classes(seeds: DataFrame) -> DataFrame:
    """Distinct token sets without pure numbers: fp (by which a set is known), rep (smallest seed), n and the hashes; no empty set."""
    sets = seeds.select("seed_id", F.lower("query").alias("query")).mapInArrow(_sets, "seed_id string, fp long, fp2 long, n int, hashes binary")
    return sets.groupBy("fp", "fp2").agg(F.min("seed_id").alias("rep"), F.first("n").alias("n"), F.first("hashes").alias("hashes")).drop("fp2")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a piece's sets and how many of these have each."""
    for piece in _sliced(batches, "hashes", 16 * PIECE):
        h, count = np.unique(_bytes(piece.column("hashes"))[0].view(U), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(count)], ["h", "df"])


def _places(tenths: int, known: np.ndarray, frequency: np.ndarray, least: int) -> Callable:
    """Places of the prefixes: token h, its set's fp, n, the place and the signature; ``known`` hashes in order have ``frequency``, others less than ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _sliced(batches, "hashes"):
            data, off = _bytes(piece.column("hashes"))
            h, off = np.frombuffer(data.tobytes(), U), off // 8
            n, fp = np.diff(off), piece.column("fp").to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            df = np.full(len(h), least - 1)
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                df = np.where(known[at] == h, frequency[at], df)
            order = np.lexsort((df, row))  # hashes are in order
            place = np.arange(len(h)) - np.repeat(off[:-1], n)
            size = n[row]
            ordered = h[order]
            kept = (place < size - (tenths * size + 9) // 10 + 1) & (df[order] > 1) & (10 * size >= tenths * (size + 1))  # a smaller set is near itself only
            width = _width(n)
            for w in np.unique(width):
                rows = np.flatnonzero(width == w)
                of = np.full(len(n), -1)
                of[rows] = np.arange(len(rows))
                mine = of[row] >= 0
                step = max(1, PIECE // (64 * int(w)))
                took = kept & mine
                for low in range(0, len(rows), step):  # a bounded number of bits at a time
                    some = mine & (of[row] >= low) & (of[row] < low + step) if len(rows) > step else mine
                    count = min(step, len(rows) - low)
                    bits = np.bincount((of[row[some]] - low) * (64 * w) + (h[some] & U(64 * w - 1)).astype(np.int64), minlength=count * 64 * w) & 1
                    signature = np.packbits(bits.astype(np.uint8), bitorder="little").reshape(count, 8 * w)
                    which = np.flatnonzero(took & some) if len(rows) > step else np.flatnonzero(took)
                    for begin in range(0, len(which), step):
                        part = which[begin : begin + step]
                        drawn = np.ascontiguousarray(signature[of[row[part]] - low])
                        ends = np.arange(len(part) + 1, dtype=np.int32) * np.int32(8 * w)
                        signed = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(drawn)])
                        arrays = [pa.array(ordered[part].view(np.int64)), pa.array(fp[row[part]]), pa.array(size[part].astype(np.int32)), pa.array(place[part].astype(np.int32)), signed]
                        yield pa.RecordBatch.from_arrays(arrays, ["h", "fp", "n", "place", "signature"])

    return run


def _width(n: np.ndarray) -> np.ndarray:
    """Words of the signature of a set of n tokens."""
    return WORDS << np.ceil(np.log2(np.maximum(n / NARROW, 1))).astype(np.int64)


def _whole(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that are ordered by the column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = batch.column(column)[-1]
        if held[0].column(column)[0] == last:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(column).combine_chunks() if isinstance(table.column(column), pa.ChunkedArray) else table.column(column)
        cut = int(np.flatnonzero(keys.to_numpy(zero_copy_only=False) != last.as_py())[-1]) + 1
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of the component of each of n nodes, by minimum labels and pointer jumping."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while ((jumped := label[label]) != label).any():
            label = jumped
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


class _Signatures:
    """Signatures of rows at any width up to their own."""

    def __init__(self, column: pa.ChunkedArray):
        self.data, self.off = _bytes(column)
        self.width = np.diff(self.off) // 8
        self.at: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def rows(self, rows: np.ndarray, width: int) -> np.ndarray:
        if width not in self.at:
            of, parts, count = np.full(len(self.width), -1), [], 0
            for w in np.unique(self.width[self.width >= width]):
                mine = np.flatnonzero(self.width == w)
                whole = self.data[(self.off[mine, None] + np.arange(8 * w))].view(U).reshape(len(mine), -1, width)
                parts.append(np.bitwise_xor.reduce(whole, axis=1))
                of[mine] = count + np.arange(len(mine))
                count += len(mine)
            self.at[width] = of, np.concatenate(parts)
        of, words = self.at[width]
        return words[of[rows]]


def _forests(tenths: int) -> Callable:
    """Spanning forests (a, b) of the pairs of one token's sets that may be near."""

    def joined(table: pa.Table) -> np.ndarray:
        """Smallest row of each row's component."""
        h, n, place = _numbers(table, "h"), _numbers(table, "n").astype(np.int64), _numbers(table, "place")
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        scale = int(n.max()) + 1
        end = np.searchsorted(group * scale + n, group * scale + np.minimum(10 * n // tenths, scale - 1), "right")
        smaller = place < n + (-2 * tenths * n) // (10 + tenths) + 1
        count = np.where(smaller, end - np.arange(len(n)) - 1, 0)
        signatures, label = _Signatures(table.column("signature")), np.arange(len(n))
        total = np.cumsum(count)
        row = 0
        while row < len(n):
            done = int(total[row - 1]) if row else 0
            stop = max(row + 1, int(np.searchsorted(total, done + PAIRS, "right")))
            rows, times = np.arange(row, stop), count[row:stop]
            row = stop
            i = np.repeat(rows, times)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
            some = label[i] != label[j]
            i, j = i[some], j[some]
            both = n[i] + n[j]
            spare = 1 + (-tenths * both) // (10 + tenths)  # one more than the tokens that they must share, taken off
            some = (place[i] < n[i] + spare) & (place[j] < n[j] + spare)
            i, j, both = i[some], j[some], both[some]
            least = np.minimum(signatures.width[i], signatures.width[j])
            fit = np.zeros(len(i), bool)
            for w in np.unique(least):
                same = np.flatnonzero(least == w)
                apart = np.bitwise_count(signatures.rows(i[same], int(w)) ^ signatures.rows(j[same], int(w))).sum(axis=1, dtype=np.int64)
                fit[same] = (10 + tenths) * apart <= (10 - tenths) * both[same]
            if fit.any():
                label = _roots(label[i[fit]], label[j[fit]], len(label))[label]
        return label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "h"):
            fp, label = _numbers(table, "fp"), joined(table)
            low = fp.copy()
            np.minimum.at(low, label, fp)
            low = low[label]
            more = fp != low
            yield pa.RecordBatch.from_arrays([pa.array(fp[more]), pa.array(low[more])], ["a", "b"])

    return run


def connected(edges: DataFrame, folder: str, most_rounds: int = 60) -> DataFrame:
    """node and root (the smallest node reachable) of every node of the edges (a, b), by large and small star steps written to the folder; raises after ``most_rounds``."""

    def mark(now: DataFrame) -> tuple:
        r = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return r["n"], r["x"]

    now = _written(edges.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), folder)
    before = mark(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) as m")
        large = both.join(least, "a").where("b > a").selectExpr("b as a", "m as b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        now = _written(large.join(lower, "a").where("b <> m").selectExpr("b as a", "m as b").unionByName(lower.selectExpr("a", "m as b")).distinct(), folder)
        after = mark(now)
        if after == before:
            return now.selectExpr("a as node", "b as root").unionByName(now.selectExpr("b as node", "b as root").distinct())
        before = after
    raise RuntimeError(f"components still changed after {most_rounds} rounds")


def _shared(row: np.ndarray, code: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of codes that the sets left and right (ranges of rows, as slices' ends) have in common; rows are in order, codes once a row."""
    (a, z), (c, y) = left, right
    lo, hi = min(a, c), max(z, y)
    some = slice(*np.searchsorted(row, [lo, hi]))
    row, code = row[some], code[some]
    code = np.unique(code, return_inverse=True)[1]
    common = np.bincount(code)[code] > 1
    row, code = row[common], np.unique(code[common], return_inverse=True)[1]
    out = np.zeros((z - a, y - c), np.float32)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    top = int(code[-1]) + 1 if len(code) else 0
    for begin in range(0, top, COLUMNS):
        part = slice(*np.searchsorted(code, [begin, begin + COLUMNS]))
        dense = np.zeros((hi - lo, min(COLUMNS, top - begin)), np.float32)
        dense[row[part] - lo, code[part] - begin] = 1
        out += dense[a - lo : z - lo] @ dense[c - lo : y - lo].T
    return out.astype(np.int64)


def _compared(tenths: int) -> Callable:
    """Near pairs of each block pair's texts: left_id, right_id, tokens shared and tokens of either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "met"):
            met, second = table.column("met").combine_chunks(), _numbers(table, "second")
            key = met.dictionary_encode()
            key = (key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key).indices.to_numpy()
            rep = table.column("rep").combine_chunks()
            data, length, row = _tokens(*_bytes(table.column("query")))
            token = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(length)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
            code = token.dictionary_encode().indices.to_numpy().astype(np.int64)
            scale = int(code.max(initial=0)) + 1
            row, code = np.divmod(np.unique(row * scale + code), scale)
            n = np.bincount(row, minlength=len(key))
            bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            found: list[tuple[np.ndarray, ...]] = []
            for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                alone, middle = second[a] < 0, a + int(np.searchsorted(second[a:z], 1))  # rows of the second block come last
                left, right = ((a, z), (a, z)) if alone else ((a, middle), (middle, z))
                s = _shared(row, code, left, right)
                either = n[left[0] : left[1], None] + n[None, right[0] : right[1]] - s
                fit = (10 * s >= tenths * either) & (either > 0)
                if alone:
                    fit = np.triu(fit, 1)
                i, j = np.nonzero(fit)
                if len(i):
                    found.append((i + left[0], j + right[0], s[i, j], either[i, j]))
            if found:
                i, j, s, either = (np.concatenate(x) for x in zip(*found, strict=True))
                for begin in range(0, len(i), PAIRS):
                    part = slice(begin, begin + PAIRS)
                    yield pa.RecordBatch.from_arrays([rep.take(pa.array(i[part])), rep.take(pa.array(j[part])), pa.array(s[part]), pa.array(either[part])], ["x", "y", "shared", "either"])

    return run


def _deleted(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _members(seeds: DataFrame, tenths: int, most_known: int, folder: str) -> DataFrame:
    """fp, root, blocks and rep of the classes in a component, which is dealt to so many blocks."""
    classes = _written(token_classes(seeds), folder)
    frequency = _written(classes.select("hashes").mapInArrow(_counted, "h long, df long").groupBy("h").agg(F.sum("df").alias("df")), folder)
    above = frequency.agg(*[F.count(F.when(F.col("df") >= 2**k, 1)) for k in range(1, 63)]).first()
    least = 2 ** (1 + next(k for k, n in enumerate((*above, 0)) if n <= most_known))
    often = frequency.where(F.col("df") >= least).toArrow()
    h, df = often.column("h").to_numpy().view(U), often.column("df").to_numpy()
    order = np.argsort(h)
    places = classes.select("fp", "hashes").mapInArrow(_places(tenths, h[order], df[order], least), "h long, fp long, n int, place int, signature binary")
    members = connected(places.repartition("h").sortWithinPartitions("h", "n").mapInArrow(_forests(tenths), "a long, b long"), folder)
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return members.join(sizes, "root").selectExpr("node as fp", "root", "blocks").join(classes.select("fp", "rep"), "fp")


def near_pairs(seeds: DataFrame, tenths: int, most_known: int) -> DataFrame:
    """left_id, right_id and jaccard of the classes' representatives with Jaccard of at least tenths / 10; ``most_known`` tokens at most have their frequencies copied to tasks."""
    spark = seeds.sparkSession
    folder = new_folder(spark)
    try:
        members = _written(_members(seeds, tenths, most_known, folder), new_folder(spark))
    finally:
        _deleted(spark, folder)
    texts = seeds.select(F.col("seed_id").alias("rep"), F.lower("query").alias("query"))
    few = members.count() <= most_known
    mine = texts.join(F.broadcast(members) if few else members, "rep").dropDuplicates(["rep", "query"]).withColumn("block", F.expr("cast(pmod(xxhash64(fp), blocks) as int)"))
    dealt = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("rep", "query", F.concat_ws(" ", "root", F.least("block", "other"), F.greatest("block", "other")).alias("met"), F.expr("cast(sign(block - other) as int)").alias("side"))
    dealt = dealt.withColumn("second", F.when(F.col("side") == 0, -1).when(F.col("side") > 0, 1).otherwise(0)).drop("side")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: not to be coalesced
    pairs = dealt.repartition(spread, "met").sortWithinPartitions("met", "second").mapInArrow(_compared(tenths), "x string, y string, shared long, either long")
    return pairs.where("x <> y").select(F.least("x", "y").alias("left_id"), F.greatest("x", "y").alias("right_id"), F.round(F.col("shared") / F.col("either"), 6).alias("jaccard"))
