"""Whole-text token ids by the tokenizers library, each distinct span encoded once per worker.

Spans are chosen so that encoding them apart equals encoding the text: matches of the byte-level
split pattern for a byte-level vocabulary, white-space separated words for a vocabulary whose
pre-tokenizer drops white space.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from trajlake.llm.text import SpanCoder, per_text, pretokens, utf8, words

#: Separates words that are encoded together; spans that hold it are encoded apart.
MARK = "\x01"
#: Matches of the byte-level pattern that stay apart from a mark after them: all but runs of other
#: characters (the mark is one of them), white space and contractions.
_LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3(?![\x97\xb7])[\x80-\xbf]|[\xc4-\xc9][\x80-\xbf])+\Z")
_ANY = re.compile(rb"")

_loaded: dict[tuple[str, str], SpanCoder] = {}


def coder(path: str, spans: str) -> SpanCoder:
    if (path, spans) not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # a special token's string in a text is ordinary text

        def ids_of(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        mark = ids_of([MARK])[0]
        joint = None if len(mark) != 1 else _LETTERS if spans == "pattern" else _ANY

        def encode(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            """Many words in one text, apart by a word of the mark alone: the library's cost is by text."""
            odd = [k for k, p in enumerate(parts) if joint is None or MARK.encode() in p or not joint.match(p)]
            apart = dict(zip(odd, ids_of([parts[k].decode() for k in odd]), strict=True))
            rest = [p.decode() for k, p in enumerate(parts) if k not in apart] if apart else [p.decode() for p in parts]
            glue = MARK if spans == "pattern" else f" {MARK} "
            joined_up = [glue.join(rest[at : at + 512]) + glue for at in range(0, len(rest), 512)]
            runs = [np.array(x, dtype=np.uint32) for at in range(0, len(joined_up), 8) for x in ids_of(joined_up[at : at + 8])]  # few at a time: an encoding is many times its ids
            flat = np.concatenate(runs) if runs else np.zeros(0, np.uint32)
            ends = np.flatnonzero(flat == mark[0])
            count = np.diff(ends, prepend=-1) - 1
            flat = flat[flat != mark[0]]
            if apart:
                own = np.zeros(len(parts), np.int64)
                joined = np.ones(len(parts), bool)
                joined[odd] = False
                own[joined] = count
                own[odd] = [len(apart[k]) for k in odd]
                all_ids = np.zeros(int(own.sum()), np.uint32)
                of = np.repeat(joined, own)
                all_ids[of] = flat
                all_ids[~of] = [i for k in odd for i in apart[k]]
                return all_ids, own
            return flat, count

        _loaded[path, spans] = SpanCoder(encode)
    return _loaded[path, spans]


def text_ids(column: pa.Array, path: str, spans: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column, flat, and each text's offsets in them. spans: "pattern" or "words"."""
    data, off = utf8(column)
    start, end, text = (pretokens if spans == "pattern" else words)(data, off)
    ids, count = coder(path, spans)(data, start, end)
    return ids, per_text(count, text, len(off) - 1)
