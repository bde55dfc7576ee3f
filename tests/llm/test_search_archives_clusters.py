"""Lexical search, archives and centroid clustering against brute force, with odd rows, ties and damaged files."""

from __future__ import annotations

import base64
import collections
import hashlib
import io
import math
import os
import random
import re
import struct

import numpy as np
import pytest
import zstandard

from trajlake.llm import best_position, drift_clusters, warc, workspace
from trajlake.llm.text import distinct_spans

RNG = random.Random(12)
VOCAB = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(1, 4))) for _ in range(150)] + ["Ünï", "x1", "Été"]


# --- lexical search


def _searched(docs, items, k=10):
    """Every score of every pair, in Python's whole numbers."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    bags = [collections.Counter(term.findall((t or "").translate(lower))) for _, t in docs]
    lengths = [sum(b.values()) for b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = collections.Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        asked = term.findall((text or "").translate(lower))
        scored = []
        for (doc, _), bag, length in zip(docs, bags, lengths, strict=True):
            m = 25 + (75 * length * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in asked if bag[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if none else doc, -score) for r, (score, none, doc) in enumerate(sorted(scored)[:k])]
    return out


def _docs():
    out = [(k, " ".join(RNG.choices(VOCAB, weights=[1 / (j + 1) for j in range(len(VOCAB))], k=RNG.randint(1, 150)))) for k in range(400)]
    out += [(1000 + k, out[7][1]) for k in range(40)]  # one text many times: ties at the k-th place
    return out + [(None, out[7][1]), (7, out[7][1]), (2000, None), (2001, ""), (2002, "?! --"), (2003, "ab.CD\x00ef_gh " + "a " * 30000)]


ITEMS = [(k, " ".join(RNG.choices(VOCAB, k=RNG.randint(1, 12)))) for k in range(30)] + [(100, None), (101, "..."), (102, "unheard of"), (103, "a a A b b"), (None, "ab cd")]


def _tables(spark, docs, items):
    a = spark.createDataFrame([(d, t, 1, "s", 2) for d, t in docs], "doc_id long, text string, score int, terms string, rank int").repartition(7)
    return a, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def _key(rows):
    return sorted(rows, key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(best_position, "SHARD_BYTES", 4000)
    docs = _docs()
    items = ITEMS + [(200, docs[7][1])]
    df, queries = _tables(spark, docs, items)
    got = [tuple(r) for r in best_position.search(df, queries).collect()]
    assert _key(got) == _key(_searched(docs, items))


def test_search_in_blocks_over_an_index_of_all_terms(spark, monkeypatch):
    docs = _docs()
    df, queries = _tables(spark, docs, ITEMS)
    want = _key(_searched(docs, ITEMS, 3))
    monkeypatch.setattr(best_position, "BLOCK_BYTES", 60)
    assert _key(tuple(r) for r in best_position.search(df, queries, k=3).collect()) == want
    index = workspace.written(best_position.index(df))
    assert _key(tuple(r) for r in best_position.search_index(index, queries, k=3).collect()) == want


def test_search_of_nothing(spark):
    df, queries = _tables(spark, _docs(), ITEMS)
    for a, b in ((df.limit(0), queries), (df, queries.limit(0)), (df.where("doc_id in (2000, 2001)"), queries)):
        assert best_position.search(a, b).collect() == []


def test_reading_stops_early_and_keeps_ties():
    n = 20_000
    rng = np.random.default_rng(3)
    lists = []
    for _ in range(3):
        doc = np.sort(rng.choice(n, n // 2, replace=False))
        value = np.sort(rng.integers(1, 1000, len(doc)))
        value[-5:] = 100_000  # the same documents lead every list
        doc = np.concatenate([np.setdiff1d(doc, np.arange(5))[: len(doc) - 5], np.arange(5)])
        at = np.argsort(doc, kind="stable")
        doc, value = doc[at], value[at]
        order = np.argsort(-value, kind="stable")
        position = np.empty(len(order), np.int64)
        position[order] = np.arange(len(order))
        lists.append((doc, value, order, position))
    found, looked = best_position.best(lists, [1, 1, 1], list(range(n)), 5, [])
    assert [d for _, _, d in found] == [0, 1, 2, 3, 4] and looked < 100
    again, looked = best_position.best(lists, [1, 1, 1], list(range(n)), 5, [(-400_000, False, 77)] * 5)
    assert looked == 0 and len(again) == 5
    tied, _ = best_position.best(lists, [1, 1, 1], [9 - d if d < 5 else d + 10 for d in range(n)], 3, [])
    assert [d for _, _, d in tied] == [5, 6, 7]


def test_distinct_spans_with_equal_hashes(monkeypatch):
    from trajlake.llm import text

    data = np.frombuffer(b"abcdabxyab", np.uint8)
    start, end = np.array([0, 2, 4, 6, 8]), np.array([2, 4, 6, 8, 10])
    for _ in range(2):
        which, names = distinct_spans(data, start, end)
        assert [names[w] for w in which] == [b"ab", b"cd", b"ab", b"xy", b"ab"] and len(names) == 3
        monkeypatch.setattr(text, "span_hash", lambda d, s, e: np.zeros(len(s), np.uint64))


# --- archives


def _pages():
    big = "<p>" + "many words here " * 3000
    rows = [(k, f"http://h/{k}", f"<html><body>page {k % 40} äé</body></html>") for k in range(120)]
    rows += [(500, "http://h/é b\r\nX: y", big), (499, None, big), (None, "http://h/n", big), (501, "u", None), (502, "u", "")]
    rows += [(300, "same", "<b>again</b>")] * 50 + [(300, "other", "<b>again</b>"), (299, None, "unlike"), (None, None, "only null"), (None, None, "only null")]
    return rows


def _archived(rows, least=0):
    def order(r):
        return (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")

    def order_nulls_last(r):
        return (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")

    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[2] or "").encode()].append(r)
    out = []
    for raw, group in groups.items():
        group = sorted(group, key=order_nulls_last)
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        for k, r in enumerate(group):
            first = k == 0 or len(raw) < least
            out.append((r[0], len(raw), sha, "response" if first else "revisit", None if first else group[0][0]))
    return sorted(out, key=repr)


def _read_back(files):
    got = warc.read(files).collect()
    assert all(r["issue"] is None for r in got), [r for r in got if r["issue"]][:3]

    def page(name):
        m = re.match(r"urn:trajlake:page:(-?\d+|none):", name) if name else None
        return int(m[1]) if m and m[1] != "none" else None

    return got, sorted(((page(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], page(r["refers_to"])) for r in got), key=repr)


@pytest.mark.parametrize("few", [500_000, 0])
@pytest.mark.parametrize("least", [0, 20])
def test_archives_hold_every_page_once(spark, few, least):
    rows = _pages()
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, n int, key string").repartition(3)
    manifest = warc.write(df, least=least, few=few)
    got, said = _read_back(manifest)
    assert said == _archived(rows, least)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows) == len({r["record_id"] for r in got})
    responses = {r["record_id"] for r in got if r["record_type"] == "response"}
    assert all(r["refers_to"] in responses for r in got if r["record_type"] == "revisit")
    assert {r["payload"].decode() for r in got if r["payload"] is not None} == {r[2] or "" for r in rows}
    assert all("\n" not in r["target_uri"] and " " not in r["target_uri"] for r in got)
    folder = manifest.first()["uri"].rsplit("/", 1)[0]
    assert warc.archives(spark, folder).count() == manifest.count()
    assert _read_back(warc.archives(spark, folder))[1] == said


def test_copies_beyond_ten_thousand(spark):
    df = spark.range(25_003).selectExpr("7L as page_id", "'u' as url", "'<p>copy' as html")
    got = warc.read(warc.write(df), payloads=False).groupBy("record_type", "refers_to").count().collect()
    assert sorted(r["count"] for r in got) == [1, 25_002]


def test_no_pages_no_archive(spark):
    manifest = warc.write(spark.createDataFrame([], "page_id long, url string, html string"))
    assert manifest.count() == 0 and warc.read(manifest).collect() == []


def _record(body=b"hello", length=None, kind="resource", extra=(), version="WARC/1.1"):
    head = [version, f"WARC-Type: {kind}", "WARC-Record-ID: <urn:x:1>", "WARC-Date: 2020-01-01T00:00:00Z", *extra, f"Content-Length: {len(body) if length is None else length}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _issues(parts: bytes, chunk: int | None = None):
    stream = io.BytesIO(parts)
    if chunk:  # a stream that gives a few bytes at a time
        whole = stream
        stream = type("Slow", (), {"read": lambda self, n: whole.read(min(n, chunk))})()
    return [issue or warc.described(content)["issue"] for _, content, issue in warc.frames(stream)]


def _skippable(raw: bytes, magic: int = warc.DICTIONARY_FRAME) -> bytes:
    return struct.pack("<II", magic, len(raw)) + raw


def test_dictionaries_frames_and_lengths():
    samples = [_record(b"sample number %d with shared words and more of them" % k) for k in range(300)]
    own = warc.dictionary(samples)
    assert own.as_bytes()[:4] == struct.pack("<I", warc.TRAINED)
    raw = zstandard.ZstdCompressionDict(b"WARC/1.1\r\nWARC-Type: resource", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    plain = zstandard.ZstdCompressor()
    for d in (own, raw):
        frames = zstandard.ZstdCompressor(dict_data=d)
        unsized = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=True)
        body = frames.compress(samples[0]) + _skippable(b"note", 0x184D2A51) + unsized.compress(_record(b"q" * 300_000)) + unsized.compress(_record(os.urandom(200_000)))
        for lead in (d.as_bytes(), plain.compress(d.as_bytes())):
            for chunk in (None, 7001):
                assert _issues(_skippable(lead) + body, chunk) == [None] * 3
    assert _issues(_skippable(b"\x37\xa4\x30\xecnot a dictionary") + zstandard.ZstdCompressor(dict_data=own).compress(samples[0])) == ["dictionary"]
    assert _issues(plain.compress(_record())) == [None] and _issues(b"") == []


def test_damage_costs_one_record():
    frame = zstandard.ZstdCompressor(write_checksum=True).compress
    good = frame(_record(b"good " * 50))
    broken = bytearray(frame(_record(os.urandom(500))))
    broken[-1] ^= 255
    assert _issues(good + bytes(broken) + good) == [None, "frame", None]
    assert _issues(good + good[:-3]) == [None, "truncated"] and _issues(good + b"junk") == [None, "frame"] and _issues(good + b"\x28") == [None, "frame"]
    digest = "WARC-Block-Digest: sha1:" + warc.digest(b"hello")
    for raw, issue in [
        (_record(length=4), "length"), (_record(length=6), "length"), (_record(length="x"), "length"), (_record() + _record(), "length"),
        (_record(version="WARC/9"), "version"), (b"no record", "header"), (_record(extra=["no colon"]), "header"), (_record(extra=["WARC-Type: twice"]), "header"),
        (_record()[:-2] + b"xx", "trailer"), (_record(extra=[digest]), None), (_record(b"hellO", extra=[digest]), "digest"), (_record(extra=["Note: folded", "  value"]), None),
        (_record(b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nhello", extra=["Content-Type: application/http"]), "http_length"),
        (_record(b"no header", extra=["Content-Type: application/http"]), "http"),
        (_record().replace(b"WARC-Date", b"WARC-Dote"), "header"),
    ]:
        assert _issues(frame(raw) + good) == [issue, None], raw


# --- centroid clustering


def _clustered(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    x = np.array([v for _, v in kept], dtype=np.int64).reshape(len(kept), dims)
    c = x[:k].copy()

    def assigned():
        d = np.stack([((x - m) ** 2).sum(axis=1) for m in c], axis=1)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds if len(kept) else 0):
        near, _ = assigned()
        for j in range(len(c)):
            if (near == j).any():
                c[j] = [int(s) // int((near == j).sum()) for s in x[near == j].sum(axis=0)]
    if not kept:
        return []
    near, d = assigned()
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c.tolist()]
    return sorted(((i, int(j), int(e), int(d[near == j].sum()), int(d.sum()), names[j]) for (i, _), j, e in zip(kept, near, d, strict=True)), key=repr)


def _vectors(clusters=6, n=900, spread=0.05):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((clusters, 64))
    rows = [(int(k), (centre[k % clusters] + spread * rng.standard_normal(64)).tolist()) for k in range(n)]
    bad = [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [float("nan")] * 64), (2004, [None] + [1.0] * 63), (2005, [float("inf")] + [0.0] * 63)]
    return rows + bad + [(None, rows[0][1]), rows[3], rows[3], (2006, [0.0] * 64), (2007, [-0.0001] * 64)]


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, x string").repartition(5)


def test_clusters_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(drift_clusters, "PIECE", 64)
    for rows in (_vectors(), _vectors(clusters=300, spread=1.0)):
        said = []
        got = drift_clusters.cluster(_table(spark, rows), report=said)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == _clustered(rows)
        if rows is not None and len(said) == 11:
            assert said[0]["scanned"] >= said[-1]["scanned"]
    said = []
    drift_clusters.cluster(_table(spark, _vectors()), report=said)
    assert said[-1]["scanned"] < said[0]["scanned"] / 4  # vectors with clusters among them are mostly left alone


def test_few_equal_and_huge_vectors(spark):
    for rows in ([(5, [0.5] * 64)], [(k, [0.25] * 64) for k in range(30)], [(k, [float(k % 3)] * 64) for k in range(4)], [(1, [1.0] * 64), (1, [2.0] * 64), (2, [3.0] * 64)]):
        assert sorted((tuple(r) for r in drift_clusters.cluster(_table(spark, rows)).collect()), key=repr) == _clustered(rows)
    assert drift_clusters.cluster(_table(spark, []).limit(0)).collect() == [] and drift_clusters.cluster(_table(spark, [(1, None)])).collect() == []
    huge = drift_clusters.cluster(_table(spark, [(k, [1e300 * (-1) ** k] * 64) for k in range(12)]), k=2)
    assert huge.count() == 12 and all(r["distance"] >= 0 for r in huge.collect())


def test_geometric_drift_bounds_every_point_of_the_sphere():
    rng = np.random.default_rng(1)
    tighter = 0
    for _ in range(400):
        dims = int(rng.integers(2, 6))
        centre, old = rng.standard_normal(dims) * 3, rng.standard_normal(dims) * 3
        new = old + rng.standard_normal(dims) * rng.choice([0.1, 1.0, 4.0])
        radius = float(rng.choice([0.01, 0.3, 1.0, 3.0]))
        bound = drift_clusters.loosened(centre, radius, old, new)
        z = rng.standard_normal((2000, dims))
        z = centre + radius * z / np.linalg.norm(z, axis=1, keepdims=True) * np.append(np.ones(1000), rng.random(1000))[:, None]
        loss = np.linalg.norm(z - old, axis=1) - np.linalg.norm(z - new, axis=1)
        drift = np.linalg.norm(new - old)
        assert loss.max() <= bound + 1e-9 and bound <= drift + 1e-12
        tighter += bound < 0.9 * drift
    assert tighter > 150
    assert drift_clusters.loosened(np.zeros(2), 1.0, np.ones(2), np.ones(2)) == 0.0
