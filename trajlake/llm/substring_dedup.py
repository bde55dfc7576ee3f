"""Exact substring deduplication by prefix-partitioned suffix trees.

A repeated passage is an internal node of the corpus suffix tree at least ``window`` words deep. The tree
is never built in one place: suffixes are split by their first words to groups that fit memory, and each
group's subtrees are grown by themselves.

1. Texts are cut to pieces of some MB, written once. Of the suffixes only those begin a group that no
   window can do without: the smallest ``prefix``-word hash of each window (its minimizer) stands at the
   same place in equal windows. A window begins up to ``window - prefix`` words before its suffix.
2. Prefixes of variable length: suffixes are counted by the hash of their first ``prefix`` words, once a
   piece. What occurs once is a leaf and goes. A prefix with more than ``group`` suffixes grows: the
   places where a window may begin are quartered, which makes more words common to all windows of a part,
   level by level until the whole window is the prefix. By hash, light prefixes share a bucket; buckets
   are as many as the suffixes' bytes ask for.
3. A bucket's suffixes are laid out as words, to the right of the suffix's begin and, reversed, to its
   left, and both tries are grown word by word from the root; suffixes alone in a node end there. Nodes are
   told apart by the words themselves, hashes only choose the bucket. A window is repeated where the node
   of its right part and the node of its left part have two suffixes in common; the least and the greatest
   such place around a suffix bound a maximal repeat.
4. Every word inside a maximal repeat is removed from its document.

Equal surroundings within a piece travel once, with their places: a passage of which all documents hold a
copy costs a row a piece, not a row a document, once its prefix has grown to the window.

Cases: a null or empty text has no words and nothing removed; texts shorter than a window keep all words;
very long texts are taken whole; repeated rows repeat each other's windows, so all their windows go; an
empty table gives an empty result; carried columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trajlake.llm.blocks import U, packed, partitions_for, runs, sliding, unpacked
from trajlake.llm.text import blank, mix, release, span_hash, utf8, window_hash, words
from trajlake.llm.workspace import kept, scratch, written

#: Bytes of one suffix with its surroundings, about; of a bucket; and most prefixes that may grow at once.
SUFFIX_BYTES, BUCKET_BYTES, MOST_GROWN = 450, 4 << 20, 4_000_000


def ranges(level: int, most: int) -> list[tuple[int, int]]:
    """Places 0 to ``most`` where a window may begin before its suffix, quartered ``level`` times."""
    edges = sorted({k * (most + 1) // 4**level for k in range(4**level + 1)})
    return [(a, b - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Suffixes:
    """Words of some texts and the suffixes that begin groups."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, window: int, prefix: int):
        self.data, off = utf8(column)
        self.start, self.end, self.text = words(self.data, off)
        self.window, self.most = window, window - prefix
        self.count = np.bincount(self.text, minlength=len(off) - 1)
        self.first = np.cumsum(self.count) - self.count
        self.word = span_hash(self.data, self.start, self.end)
        n, span = len(self.text), window - prefix + 1
        if n < window:
            self.at = np.zeros(0, np.int64)
            return
        inside = self.text[: n - window + 1] == self.text[window - 1 :]
        hashed = window_hash(self.word, prefix)
        least = np.where(inside, sliding(np.minimum, hashed, span), U(0))
        held = np.concatenate([np.zeros(span - 1, U), least, np.zeros(span - 1, U)])
        self.at = np.flatnonzero((sliding(np.maximum, held, span) == hashed) & (sliding(np.maximum, np.concatenate([np.zeros(span - 1, np.int8), inside.astype(np.int8), np.zeros(span - 1, np.int8)]), span) > 0))

    def keys(self, grown: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per level: suffix, least and greatest place of its windows, prefix key. A level takes what the level before holds of ``grown``."""
        out = []
        at = self.at
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), self.most)
        for level in range(len(grown) + 1):
            key = np.zeros(len(at), U)
            fits = np.zeros(len(at), bool)
            for a, b in ranges(level, self.most):
                mine = np.flatnonzero((lo == a) & (hi == b))
                width = self.window - (b - a)
                begin = at[mine] - a
                text = self.text[at[mine]] if len(mine) else mine
                ok = (begin >= self.first[text]) & (begin + width <= self.first[text] + self.count[text])
                mine = mine[ok]
                fits[mine] = True
                if len(mine):
                    key[mine] = mix(window_hash(self.word, width, at[mine] - a) + U(a * 65_537 + b))
            at, lo, hi, key = at[fits], lo[fits], hi[fits], key[fits]
            out.append((at, lo, hi, key))
            if level < len(grown):
                more = _among(key, grown[level])
                at, lo, hi = at[more], lo[more], hi[more]
                parts = [(at, np.full(len(at), a), np.full(len(at), b), (lo <= a) & (b <= hi)) for a, b in ranges(level + 1, self.most)]
                at, lo, hi = (np.concatenate([p[k][p[3]] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
        return out


def _among(key: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(key), bool)
    return ordered[np.minimum(np.searchsorted(ordered, key), len(ordered) - 1)] == key


def deep_nodes(contexts: pa.Array, left: np.ndarray, lo: np.ndarray, hi: np.ndarray, weight: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest place, before its suffix, where a repeated window begins; -1 where there is none.

    Each context is a suffix with ``left`` words before it; its windows begin ``lo`` to ``hi`` words before
    it; it occurs ``weight`` times.
    """
    data, off = utf8(contexts.cast(pa.large_binary()).cast(pa.large_string()))
    start, end, text = words(data, off)
    spelled = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(0, np.cumsum(end - start)).astype(np.int64)), pa.py_buffer(data[~blank(data)])])
    del start, end
    word = spelled.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kinds = int(word.max()) + 1 if len(word) else 1
    n = len(left)
    count = np.bincount(text, minlength=n)
    del data, spelled, text
    origin = np.cumsum(count) - count + left  # the suffix's first word
    right = count - left

    def grow(depth: int, node: np.ndarray, step: int, room: np.ndarray) -> np.ndarray:
        """Nodes one word deeper; -1 for what is alone in its node or has no such word."""
        live = np.flatnonzero((node >= 0) & (room >= depth))
        out = np.full(n, -1, np.int64)
        if len(live):
            place = origin[live] + (depth - 1 if step > 0 else -depth)
            code, _ = pd.factorize(node[live] * kinds + word[place])
            shared = np.bincount(code, weights=weight[live]) > 1
            out[live] = np.where(shared[code], code, -1)
        return out

    most = int(hi.max()) if n else 0
    rights: dict[int, np.ndarray] = {}
    node = np.zeros(n, np.int64)
    for depth in range(1, window + 1):
        node = grow(depth, node, 1, right)
        if depth >= window - most:
            rights[depth] = node.astype(np.int32)
    least, greatest = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    node = np.zeros(n, np.int64)
    for place in range(most + 1):
        if place:
            node = grow(place, node, -1, left)
        deep = rights[window - place]
        live = np.flatnonzero((node >= 0) & (deep >= 0) & (lo <= place) & (place <= hi))
        if len(live):
            code, _ = pd.factorize(node[live] * (n + 1) + deep[live])
            found = live[(np.bincount(code, weights=weight[live]) > 1)[code]]
            least[found] = np.where(least[found] < 0, place, least[found])
            greatest[found] = place
    return least, greatest


def maximal_repeats(store: DataFrame, window: int, prefix: int, group: int) -> DataFrame:
    """piece, begins and stops (in words of the piece) of maximal repeats of at least ``window`` words; a row holds one bucket's, where those of different rows may overlap."""
    grown: list[np.ndarray] = []
    found: DataFrame | None = None
    suffixes = 0
    while True:

        def scan(batches: Iterator[pa.RecordBatch], grown: list[np.ndarray] = grown) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    part = pa.Table.from_batches([batch.slice(k, 1)])
                    key, count = np.unique(Suffixes(unpacked(part)["text"], window, prefix).keys(grown)[-1][3], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part["piece"].combine_chunks().take(pa.array(np.zeros(len(key), np.int64))), pa.array(count)], names=["key", "piece", "n"])
                    release()

        rows = written(store.mapInArrow(scan, "key long, piece long, n long"))
        counts = written(rows.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("pieces")).where("n > 1"))
        total = counts.agg(F.sum("n")).first()[0] or 0
        bound = max(group, total // MOST_GROWN)  # so at most MOST_GROWN prefixes have more suffixes
        last = all(a == b for a, b in ranges(len(grown), window - prefix))
        heavy = [] if last or total <= bound else [r["key"] for r in counts.where(F.col("n") > bound).select("key").collect()]
        light = counts.where(F.col("n") <= bound) if heavy else counts
        met = rows.join(light.select("key"), "key").select("piece", "key")
        found = met if found is None else found.unionByName(met)
        suffixes += light.agg(F.sum("pieces")).first()[0] or 0  # equal suffixes of a piece count once
        if not heavy:
            break
        grown = [*grown, np.sort(np.array(heavy, dtype=np.int64).view(U))]

    buckets = max(1, -(-suffixes * SUFFIX_BYTES // BUCKET_BYTES))
    held = partitions_for(store, store.count(), 16)

    def contexts(docs_of: pa.Table, keys_of: pa.Table) -> pa.Table:
        """Suffixes with their surroundings, equal ones once, with their places in the piece."""
        if not docs_of.num_rows or not keys_of.num_rows:
            return nothing
        s = Suffixes(unpacked(docs_of)["text"], window, prefix)
        wanted = np.unique(keys_of["key"].to_numpy().view(U))
        parts = []
        for level, (at, lo, hi, key) in enumerate(s.keys(grown)):
            some = _among(key, wanted) & ~(_among(key, grown[level]) if level < len(grown) else np.zeros(len(key), bool))
            parts.append([x[some] for x in (at, lo, hi, key)])
        at, lo, hi, key = (np.concatenate([p[k] for p in parts]) for k in range(4))
        if not len(at):
            return nothing
        text = s.text[at]
        a = np.maximum(at - hi, s.first[text])
        b = np.minimum(at - lo + window, s.first[text] + s.count[text])
        raw = s.data.tobytes()
        shape, head = np.unique(np.stack([at - a, lo, hi]), axis=1, return_inverse=True)
        heads = [x.astype("<u2").tobytes() for x in shape.T]
        head, x, y = head.ravel(), s.start[a], s.end[b - 1]
        chunks = []
        for k in range(0, len(at), 4096):  # a text of one word repeated has as many equal contexts as words
            some = slice(k, k + 4096)
            chunks.append(pa.array([heads[h] + raw[i:j] for h, i, j in zip(head[some].tolist(), x[some].tolist(), y[some].tolist(), strict=True)], pa.large_binary()).dictionary_encode())
        spelled = pa.chunked_array(chunks).unify_dictionaries().combine_chunks()
        which = spelled.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(which, kind="stable")
        times = np.bincount(which)
        places = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(times)).astype(np.int32)), pa.array(at[order].astype(np.int32)))
        first = order[np.cumsum(times) - times]
        bucket = ((key[first] >> U(20)) % U(buckets)).astype(np.int32)
        release()
        return pa.table({"bucket": pa.array(bucket), "piece": pa.array(np.full(len(first), docs_of["piece"][0].as_py())), "context": spelled.dictionary.cast(pa.binary()), "at": places})

    nothing = pa.table({"bucket": pa.array([], pa.int32()), "piece": pa.array([], pa.int64()), "context": pa.array([], pa.binary()), "at": pa.array([], pa.list_(pa.int32()))})

    def repeats(table: pa.Table) -> pa.Table:
        coded = table["context"].combine_chunks().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        at = table["at"].combine_chunks()
        times = at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        weight = np.bincount(which, weights=times)
        distinct = coded.dictionary.to_pylist()
        shape = np.frombuffer(b"".join(c[:6] for c in distinct), "<u2").reshape(-1, 3).astype(np.int64)
        least, greatest = deep_nodes(pa.array([c[6:] for c in distinct], pa.large_binary()), shape[:, 0], shape[:, 1], shape[:, 2], weight, window)
        row = np.repeat(np.arange(len(which)), times)
        hit = np.flatnonzero(least[which[row]] >= 0)
        row, place = row[hit], at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)[hit]
        number, piece = pd.factorize(table["piece"].to_numpy())
        base = number[row].astype(np.int64) << 32
        first, reach = base + place - greatest[which[row]], base + place - least[which[row]] + window
        order = np.argsort(first, kind="stable")
        first, reach = first[order], np.maximum.accumulate(reach[order])
        head = np.flatnonzero(np.append(True, first[1:] > reach[:-1])[: len(first)])
        begin, stop = first[head], reach[np.append(head[1:], len(first))[: len(head)] - 1]
        own = begin >> 32  # repeats that overlap are one; a row holds a piece's
        at_row, size = runs(own)
        cuts = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
        ends = [pa.ListArray.from_arrays(cuts, pa.array((x - (own << 32)).astype(np.int32))) for x in (begin, stop)]
        release()
        return pa.table({"piece": pa.array(piece[own[at_row]]), "begin": ends[0], "stop": ends[1]})

    with_words = store.repartition(held, "piece").groupBy("piece").cogroup(found.repartition(held, "piece").groupBy("piece")).applyInArrow(contexts, "bucket int, piece long, context binary, at array<int>")
    return with_words.repartition(partitions_for(store, buckets, 1), "bucket").groupBy("bucket").applyInArrow(repeats, "piece long, begin array<int>, stop array<int>")


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, prefix: int = 8, carry: list[str] | None = None, group: int = 50_000) -> DataFrame:
    """doc_id, n_words, n_removed and text (the kept words joined by one space) of every document, then the carried columns."""
    carried = carry or []
    names, types = [f"carry_{i}" for i in range(len(carried))], dict(df.dtypes)
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"), *[df[c].alias(k) for k, c in zip(names, carried, strict=True)])
    schema = "doc_id long, n_words long, n_removed long, text string" + "".join(f", {k} {types[c]}" for k, c in zip(names, carried, strict=True))
    nothing = to_arrow_schema(StructType.fromDDL(schema)).empty_table()
    store = packed(docs)
    with scratch(df.sparkSession):
        again = kept(maximal_repeats(store, window, prefix, group))
    held = partitions_for(store, store.count(), 16)

    def cut(docs_of: pa.Table, repeats_of: pa.Table) -> pa.Table:
        if not docs_of.num_rows:
            return nothing
        table = unpacked(docs_of)
        data, off = utf8(table["text"])
        start, end, text = words(data, off)
        count = np.bincount(text, minlength=table.num_rows)
        change = np.zeros(len(start) + 1, np.int64)
        np.add.at(change, pc.list_flatten(repeats_of["begin"]).to_numpy(), 1)
        np.add.at(change, pc.list_flatten(repeats_of["stop"]).to_numpy(), -1)
        gone = np.cumsum(change[:-1]) > 0
        kept = ~gone
        # each kept word with one space after it; the last space of a text is left out
        length = (end - start + 1)[kept]
        stop = np.cumsum(length)
        where = np.arange(int(length.sum())) - np.repeat(stop - length, length) + np.repeat(start[kept], length)
        joined = np.append(data, np.uint8(32))[np.minimum(where, len(data))] if len(where) else np.zeros(0, np.uint8)
        joined[stop - 1] = 32
        bounds = np.concatenate([[0], np.cumsum(np.bincount(text[kept], weights=length, minlength=table.num_rows).astype(np.int64))])
        raw = joined.tobytes()
        texts = [raw[a : max(a, b - 1)].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        removed = np.bincount(text[gone], minlength=table.num_rows)
        release()
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(count), "n_removed": pa.array(removed), "text": pa.array(texts, pa.string()), **{k: table[k] for k in names}})

    done = store.repartition(held, "piece").groupBy("piece").cogroup(again.repartition(held, "piece").groupBy("piece")).applyInArrow(cut, schema)
    return done.select("doc_id", "n_words", "n_removed", "text", *[F.col(k).alias(c) for k, c in zip(names, carried, strict=True)])
