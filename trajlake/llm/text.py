"""Vectorised text kernels over Arrow string columns: spans, words, pre-tokens and 64-bit span hashes.

All kernels work on one piece of a record batch (a few MB of UTF-8 bytes), never on Python
strings one by one, and treat a null text as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
PIECE_BYTES = 2 << 20
#: Text bytes at a time where a piece's distinct spans are encoded once.
LARGE_PIECE_BYTES = 4 << 20
#: Text bytes at a time where many arrays as long as the text live at once.
SMALL_PIECE_BYTES = 1 << 20

#: White space of the word rule used by the documents' contracts: U+0020 and U+0009 to U+000D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Code points with the Unicode property White_Space.
_WHITE_SPACE = [0x20, *range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = np.asarray(x, dtype=U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE_KEY = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_position_keys = mix(np.arange(1, 1025, dtype=U) * U(0xD1342543DE82EF95)) | U(1)


def _keys(n: int) -> np.ndarray:
    """Multipliers for byte positions 0..n-1, grown on demand."""
    global _position_keys
    if n > len(_position_keys):
        size = 1 << (n - 1).bit_length()
        _position_keys = mix(np.arange(1, size + 1, dtype=U) * U(0xD1342543DE82EF95)) | U(1)
    return _position_keys


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each (one more than texts); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def release() -> None:
    """Give freed memory back to the system: a worker stays for later tasks, next to its executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` text bytes each; one longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(column)))
        row = 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(off, off[row] + limit, side="right")) - 1
            stop = min(max(stop, row + 1), batch.num_rows)
            yield batch.slice(row, stop - row)
            row = stop
        release()
    release()


def blank(data: np.ndarray) -> np.ndarray:
    """Which bytes separate words."""
    return _SPACE[data]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word ``[^\\x20\\x09-\\x0D]+``, in order."""
    return spans(~blank(data), off)


def spans(solid: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of solid bytes within a text, in order."""
    n = len(solid)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < n)]
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(off, start, side="right") - 1


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are in order and do not overlap."""
    if not len(start):
        return np.zeros(0, U)
    length = end - start
    first = np.cumsum(length) - length
    position = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    picked = data if len(position) == len(data) else data[position + np.repeat(start, length)]
    value = _BYTE_KEY[picked] * _keys(int(length.max()))[position]
    return mix(np.add.reduceat(value, first) + length.astype(U) * U(0x9E3779B97F4A7C15))


def distinct_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number of each span among the distinct ones, and these; told apart by hash and then by every byte."""
    which, distinct = pd.factorize(span_hash(data, start, end))
    first = np.full(len(distinct), len(which), np.int64)
    np.minimum.at(first, which, np.arange(len(which)))
    raw, length, of = data.tobytes(), end - start, first[which]
    same = bool((length == length[of]).all())
    if same and len(start):
        shift = np.repeat(start[of] - start, length)
        at = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(np.cumsum(length) - length - start, length)
        same = bool((data[at] == data[at + shift]).all())
    if same:
        return which, [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    code: dict[bytes, int] = {}
    which = np.array([code.setdefault(raw[a:b], len(code)) for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.int64)
    return which, list(code)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def window_hash(word: np.ndarray, width: int, begin: np.ndarray | None = None) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes (may cross texts: the caller masks those), or of those that begin at ``begin``."""
    if begin is not None:
        some = np.zeros(len(begin), U)
        for k, key in enumerate(_keys(width)[:width]):
            some += word[begin + k] * key
        return mix(some)
    n = len(word) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.zeros(n, U)
    for k, key in enumerate(_keys(width)[:width]):
        total += word[k : k + n] * key
    return mix(total)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point and byte position of each character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    cp = lead.copy()
    for size, low, high, bits in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0x100, 0x07)):
        some = np.flatnonzero((lead >= low) & (lead < high))
        if len(some):
            value = lead[some] & bits
            for k in range(1, size):
                value = (value << 6) | (data[at[some] + k] & 0x3F)
            cp[some] = value
    return cp, at


_class_of: dict[int, int] = {}


def char_class(cp: np.ndarray) -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACE of each code point, from its Unicode category."""
    import regex

    small = np.full(0x250, -1, dtype=np.int8)
    out = np.full(len(cp), -1, dtype=np.int8)
    for c in np.unique(cp).tolist():
        if c not in _class_of:
            s = chr(c)
            _class_of[c] = SPACE if c in _WHITE_SPACE else LETTER if regex.match(r"\p{L}", s) else NUMBER if regex.match(r"\p{N}", s) else OTHER
        if c < len(small):
            small[c] = _class_of[c]
        else:
            out[cp == c] = _class_of[c]
    low = cp < len(small)
    out[low] = small[cp[low]]
    return out


def pretokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each match of the byte-level BPE split pattern.

    The pattern is a contraction, or an optional space with a run of letters, numbers or other
    characters, or white space; of white space before a character the last one stands apart.
    """
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    cp, at = code_points(data)
    kind = char_class(cp)
    n = len(cp)
    edge = np.searchsorted(at, off[1:-1])
    fresh = np.zeros(n + 4, dtype=bool)
    fresh[0] = fresh[n:] = True
    fresh[edge[edge < n]] = True
    cut = fresh[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero(cut[1:] & ~fresh[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
    cut[after - 1] = True
    cut[after[cp[after - 1] == 32]] = False
    mark = np.flatnonzero((cp == 39) & cut)
    if len(mark):
        padded = np.concatenate([cp, np.zeros(4, np.int32)])
        one, two = padded[mark + 1], padded[mark + 2]
        inside = ~fresh[mark + 1]
        short = inside & np.isin(one, [ord(c) for c in "stmd"])
        long = inside & ~fresh[mark + 2] & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        flags = np.concatenate([cut, np.ones(4, bool)])
        flags[mark[short | long] + 1] = False
        flags[mark[long] + 2] = False
        flags[mark[short] + 2] = True
        flags[mark[long] + 3] = True
        cut = flags[:n]
    start = at[cut]
    end = np.append(start[1:], len(data))
    return start, end, np.searchsorted(off, start, side="right") - 1


class SpanCoder:
    """Token ids of spans: every distinct span is encoded once and found again by its hash.

    ``encode`` takes distinct byte strings and returns their ids, flat, and the number of ids of
    each. What is kept is bounded: beyond ``limit`` spans it starts anew.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int = 500_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(0, U)
        self.slot = np.zeros(0, np.int64)
        self.first, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans, flat, and the number of ids of each span."""
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.key) > self.limit:
            self._clear()
        which, distinct = pd.factorize(span_hash(data, start, end))
        place = np.searchsorted(self.key, distinct)
        known = place < len(self.key)
        known[known] = self.key[place[known]] == distinct[known]
        if not known.all():
            new = np.flatnonzero(~known)
            new = new[np.argsort(distinct[new])]
            sample = np.zeros(len(distinct), np.int64)
            sample[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            raw = data.tobytes()
            flat, count = self.encode([raw[a:b] for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist(), strict=True)])
            slot = np.arange(len(self.count), len(self.count) + len(new))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, flat])
            self.key = np.insert(self.key, place[new], distinct[new])
            self.slot = np.insert(self.slot, place[new], slot)
            place = np.searchsorted(self.key, distinct)
        slot = self.slot[place][which]
        count = self.count[slot]
        before = np.cumsum(count) - count
        index = np.arange(int(count.sum()), dtype=np.int64) + np.repeat(self.first[slot] - before, count)
        return self.flat[index], count


def per_text(count: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Offsets of each text's ids (one more than texts) from the number of ids of each span."""
    return np.concatenate([[0], np.cumsum(np.bincount(text, weights=count, minlength=texts).astype(np.int64))]) if len(text) else np.zeros(texts + 1, np.int64)
