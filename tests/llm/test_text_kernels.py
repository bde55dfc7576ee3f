"""Kernels against the plain rules they vectorise."""

from __future__ import annotations

import base64
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from trajlake.llm import blocks, byte_bpe, text, tokens

RNG = random.Random(2)
LETTERS = [*"aabbcs'tdrevlm  \n\t\r.,!#123é 　ñ漢字😀\x1c\x85İΣςÀ×÷\x01", "<|endoftext|>", "é"]
FUZZ = ["".join(RNG.choice(LETTERS) for _ in range(RNG.randint(0, 60))) for _ in range(3000)] + ["", None, "a" * 3000, " " * 400, "#$" * 300, "'s'sre''s 's 're", "ab" * 900]


def test_words_follow_the_rule():
    data, off = text.utf8(pa.array(FUZZ))
    start, end, owner = text.words(data, off)
    got = [[] for _ in FUZZ]
    for a, b, k in zip(start, end, owner, strict=True):
        got[k].append(data[a:b].tobytes())
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in FUZZ]


def test_equal_spans_and_only_they_hash_alike():
    data, off = text.utf8(pa.array(FUZZ))
    start, end, _ = text.words(data, off)
    hashes = text.span_hash(data, start, end)
    words = [data[a:b].tobytes() for a, b in zip(start, end, strict=True)]
    assert len(set(words)) == len(set(hashes.tolist())) == len(set(zip(words, hashes.tolist(), strict=True)))


def test_byte_bpe_equals_the_library():
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    code, _ = byte_bpe.coder(path)
    data, off = text.utf8(pa.array(FUZZ))
    start, end, owner = text.pretokens(data, off)
    ids, count = code(data, start, end)
    bounds = text.per_text(count, owner, len(FUZZ))
    for k, t in enumerate(FUZZ):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == library.encode_ordinary(t or "")


@pytest.mark.parametrize(("file", "spans"), [("byte_bpe_50k.json", "pattern"), ("word_bpe_49k.json", "words")])
def test_whole_text_ids_equal_the_library(file, spans):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(file))
    library.encode_special_tokens = True
    ids, bounds = tokens.text_ids(pa.array(FUZZ), public_tokenizers.path(file), spans)
    for k, t in enumerate(FUZZ):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_sliding_and_components():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 50, 200)
    for width in (1, 2, 7, 28):
        assert blocks.sliding(np.minimum, a, width).tolist() == [a[i : i + width].min() for i in range(200 - width + 1)]
    x, y = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    parent = list(range(300))

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, j in zip(x.tolist(), y.tolist(), strict=True):
        p, q = root(i), root(j)
        parent[max(p, q)] = min(p, q)
    assert blocks.components(x, y, 300).tolist() == [root(v) for v in range(300)]


def test_a_piece_never_splits_or_loses_a_row():
    rows = ["x" * RNG.randint(0, 900) for _ in range(200)] + [None, "y" * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    got = [p.column(0).to_pylist() for p in text.pieces(iter([batch]), limit=2000)]
    assert sum(got, []) == rows and all(len(p) == 1 or sum(len(t or "") for t in p) <= 2000 for p in got)
