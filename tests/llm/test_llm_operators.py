"""Operators against brute force on small tables with nulls, empties, repeats, clashing columns and no rows."""

from __future__ import annotations

import collections
import hashlib
import html.parser
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from trajlake.llm import byte_bpe, components, html_text, jaccard_join, language, neighbours, packing, perplexity, quality_rules, substring_dedup, token_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, key string, fp long, shard int, n_words int"
RNG = random.Random(4)
VOCAB = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 6))) for _ in range(300)]


def _texts():
    base = [" ".join(RNG.choice(VOCAB) for _ in range(RNG.randint(1, 120))) for _ in range(60)]
    out = list(base)
    for t in base[:25]:  # near copies
        w = t.split()
        for _ in range(max(1, len(w) // 30)):
            w[RNG.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += base[5:9] + [None, "", "  \n ", "one", "one", "ONE", "two words", "Ünïcode Ä text", "\t".join(["rep"] * 90), "x" * 20000]
    passage = " ".join(RNG.choice(VOCAB) for _ in range(50))
    out += [f"{base[k]}\n{passage} {base[k + 1]}" for k in range(30, 34)]
    return out


TEXTS = _texts()
ROWS = [(k, t, RNG.choice(["en", "fr", None]), "k", 1, 2, 3) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", "k", 1, 2, 3), (None, "no id at all", "en", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_jaccard_join_equals_brute_force(docs, nothing):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    rows = [(i, frozenset(_grams(WORD.findall((t or "").translate(lower))))) for i, t, *_ in ROWS if i is not None]
    parent = {i: i for i, _ in rows}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in rows:
        for j, b in rows:
            if a and b and i < j and 100 * len(a & b) >= 75 * len(a | b):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    want = collections.Counter((i, len(s), root(i)) for i, s in rows)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs).where("doc_id is not null").collect())
    assert got == want
    assert jaccard_join.join(nothing).count() == 0


def _grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def test_small_blocks_give_the_same_links(spark, docs, monkeypatch):
    want = sorted(map(str, jaccard_join.join(docs).collect()))
    for most, hubs in ((60, 1), (25, 2)):
        monkeypatch.setattr(jaccard_join.links, "__defaults__", (most, hubs))
        assert sorted(map(str, jaccard_join.join(docs).collect())) == want


def test_connected_equals_a_loop(spark):
    rng = random.Random(9)
    edges = [(rng.randint(-80, 80), rng.randint(-80, 80)) for _ in range(90)] + [(k, k + 1) for k in range(500, 540)]
    parent = {v: v for e in edges for v in e}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    tied = {v for a, b in edges if a != b for v in (a, b)}
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: root(v) for v in tied}


def _dedup(rows, window):
    tokens = [WORD.findall(t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in tokens for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, tokens, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return collections.Counter(out)


@pytest.mark.parametrize(("window", "group"), [(12, 50_000), (35, 50_000), (12, 3), (35, 2)])
def test_substring_dedup_equals_brute_force(docs, nothing, window, group):
    """Small groups make prefixes grow, level by level, to the whole window."""
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.remove(docs, window=window, group=group).collect())
    assert got == _dedup([(r[0], r[1]) for r in ROWS], window)
    assert substring_dedup.remove(nothing).count() == 0


def test_one_prefix_in_every_document(spark):
    """Every document begins alike and goes on in its own way, some after 20 words, some after 60."""
    rng = random.Random(2)
    common = [rng.choice(VOCAB) for _ in range(60)]
    rows = [(k, " ".join(common[: rng.choice([9, 20, 34, 35, 36, 60])] + [rng.choice(VOCAB) for _ in range(rng.randint(0, 60))])) for k in range(150)]
    rows += [(200 + k, " ".join([rng.choice(VOCAB)] * 3 + common[:40] * 2)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for group in (5, 50):
        got = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.remove(df, group=group).collect())
        assert got == _dedup(rows, 35)


def test_nodes_are_told_apart_by_words():
    context = pa.array([b"a b c d", b"a b x d", b"a b c d e"], pa.large_binary())
    least, greatest = substring_dedup.deep_nodes(context, np.array([1, 1, 1]), np.zeros(3, np.int64), np.ones(3, np.int64), np.ones(3), 3)
    assert least.tolist() == [0, -1, 0] and greatest.tolist() == [1, -1, 1]


def test_dedup_carries_columns_of_any_name(docs):
    r = substring_dedup.remove(docs, carry=["key", "shard", "n_words"]).where("doc_id = 0").first()
    assert r[4:] == ("k", 2, 3)


def test_byte_bpe_round_trip(docs, nothing):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = {r["doc_id"]: r["decoded_sha256"] for r in byte_bpe.round_trip(docs, path).collect()}
    assert all(got[i] == hashlib.sha256((t or "").encode()).hexdigest() for i, t, *_ in ROWS)
    plain = {r["doc_id"]: bytes(r["bytes"]) for r in byte_bpe.decode(byte_bpe.encode(docs, path), path).collect()}
    assert all(plain[i] == (t or "").encode() for i, t, *_ in ROWS)
    assert byte_bpe.round_trip(nothing, path).count() == 0


def test_packing_keeps_every_id_once(docs, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = packing.pack(docs, path, window=256, part=64, group=40).collect()
    filled = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for spans in filled.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 256
    assert sum(n for s in filled.values() for _, n in s) / (256 * len(filled)) > 0.9
    for i, t, *_ in ROWS:
        if i in (3, None):
            continue
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert packing.pack(nothing, path).count() == 0


def test_differencing_is_near_equal_and_whole():
    sizes = np.random.default_rng(0).integers(1, 200, 300)
    found = packing.windows(sizes, 1024)
    assert sorted(m for w in found for m in w) == list(range(300))
    sums = [int(sizes[w].sum()) for w in found]
    assert max(sums) <= 1024 and max(sums) - min(sums) < 40
    assert packing.windows(np.array([5]), 1024) == [[0]]


def test_token_files_follow_doc_ids(docs, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    manifest = token_files.write(docs, path, end_id=2, vocabulary=49_408, partitions=3)
    got = sorted(token_files.read(docs.sparkSession, token_files.bases(manifest)).collect(), key=lambda r: r["start"])
    at = 0
    for r, (i, t) in zip(got, sorted(((r[0], r[1]) for r in ROWS), key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.read(docs.sparkSession, token_files.bases(token_files.write(nothing, path, 2, 49_408))).count() == 0


def test_language_of_held_out_texts(spark, docs, nothing):
    rng = random.Random(1)
    alphabets = {"aa": "aeiou bcd", "bb": "eiouy fgh", "cc": "aeou xyzw", "dd": "ilmnr st", "ee": "qpkaj éè", "ff": "uvwgh ôî"}
    rows = [(k, "".join(rng.choice(alphabets[lang]) for _ in range(120)), lang) for k, lang in enumerate(sorted(alphabets) * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df.where("doc_id % 5 <> 0"))
    assert len(model.languages) == 6 and len({tuple(c) for c in model.codes.tolist()}) == 6
    named = {r["doc_id"]: r for r in language.predict(df, model).collect()}
    right = [named[k]["lang_pred"] == lang for k, _, lang in rows if k % 5 == 0]
    assert sum(right) / len(right) > 0.95
    odd = {r["doc_id"]: r for r in language.predict(spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "Ж")], "doc_id long, text string"), model).collect()}
    assert [odd[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and odd[4]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in [*named.values(), *odd.values()])
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(nothing)).collect()} == {"und"}
    assert language.predict(nothing, model).count() == 0


def test_statistics_equal_brute_force(docs, nothing):
    got = collections.Counter(tuple(r) for r in quality_rules.statistics(docs).collect())
    want = collections.Counter()
    for i, t, *_ in ROWS:
        t = t or ""
        w = WORD.findall(t)
        at = collections.defaultdict(list)
        for k in range(len(w) - 4):
            at[tuple(w[k : k + 5])].append(k)
        covered = {p for v in at.values() if len(v) > 1 for k in v for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))] += 1
    assert got == want
    assert quality_rules.statistics(nothing).count() == 0


def test_rules_are_learned_and_applied(spark, docs):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(VOCAB) + ("###" if k % 4 == 0 else "") for _ in range(30))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(400)] + [(1, None)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(df, labels).collect()}
    assert all(kept[k] == (k % 4 != 0) for k in range(400))
    unlabelled = quality_rules.judge(docs, labels.limit(0))
    assert all(r["kept"] != r["base_failed"] for r in unlabelled.collect())


def test_perplexity_equals_a_plain_model(spark, nothing, monkeypatch):
    rng = random.Random(8)
    rows = [(k, "".join(rng.choice("aab c") for _ in range(rng.randint(0, 60))) if k % 9 else None, "en" if k % 2 else None) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(80)], "doc_id long, quality int, toxic int")
    learned = [t or "" for k, t, _ in rows if k % 3 and zlib.crc32(str(k).encode()) % 5]
    want = {k: _plain_perplexity(learned, t) for k, t, _ in rows if t}
    seen = []
    for few, shard, sent in ((8_000_000, 0, 0), (0, 500_000, 32 << 20), (0, 7, 400)):  # copied; joined; many shards, each of which stands several times
        monkeypatch.setattr(perplexity, "FEW_NGRAMS", few)
        monkeypatch.setattr(perplexity, "SHARD_NGRAMS", shard)
        monkeypatch.setattr(perplexity, "SHARD_BYTES", sent)
        found = {r["doc_id"]: r for r in perplexity.classify(df, labels, least=5).collect()}
        assert len(found) == 80 and all(not found[k]["kept"] and found[k]["perplexity"] is None for k, t, _ in rows if not t)
        for k, p in want.items():
            assert found[k]["perplexity"] == pytest.approx(p, rel=1e-5)
        seen.append({k: r["perplexity"] for k, r in found.items()})
    assert seen[0] == seen[1] == seen[2]
    assert perplexity.classify(nothing.select("doc_id", "text", "lang"), labels).count() == 0


def test_labels_twice_thresholds_and_carried_columns(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(VOCAB) for _ in range(40)) if k % 10 else "".join(chr(rng.randint(33, 126)) for _ in range(200)), "en", k, True) for k in range(400)]
    df = spark.createDataFrame(rows + [rows[1], (None, "no id", None, 1, None)], "doc_id long, text string, lang string, n_bytes int, kept boolean")
    labels = spark.createDataFrame([(k, int(k % 10 != 0)) for k in range(400)] + [(1, 0), (1, None), (None, 1)], "doc_id long, quality int")
    ids = {r["doc_id"]: r["trusted"] for r in perplexity.trusted_ids(labels).collect()}
    assert 1 not in ids and 2 in ids
    found = collections.defaultdict(list)
    for r in perplexity.classify(df, labels, least=10).collect():
        found[r["doc_id"]].append(r)
    assert len(found[1]) == 2 and found[1][0] == found[1][1] and len(found) == 401
    assert all(r["kept"] == (r["adjusted"] <= r["threshold"]) for x in found.values() for r in x)
    assert sum(found[k][0]["kept"] for k in range(400) if k % 10) >= 355 and not any(found[k][0]["kept"] for k in range(0, 400, 10))
    kept = perplexity.classify(df, labels, carry=df.columns, least=10)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {k for k, x in found.items() if x[0]["kept"]}
    assert all(r["kept"] for r in perplexity.classify(df.where("doc_id < 20"), labels.limit(0)).collect())


def _plain_perplexity(trusted, t, order=5):
    """Interpolated modified Kneser-Ney by dictionaries."""

    def grams(x):
        b = bytes(order - 1) + x.encode()
        return [b[i : i + order] for i in range(len(b) - order + 1)]

    counts = {order: collections.Counter(g for x in trusted for g in grams(x))}
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    cuts, sums = {}, {}
    for n, c in counts.items():
        of = collections.Counter(c.values())
        n1, n2, n3, n4 = (of.get(k, 0) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        cuts[n] = [min(max(d, 0.05), k) for k, d in ((1, 1 - 2 * y * n2 / n1 if n1 else 0.5), (2, 2 - 3 * y * n3 / n2 if n2 else 1.0), (3, 3 - 4 * y * n4 / n3 if n3 else 1.5))]
        sums[n] = collections.defaultdict(lambda: [0, 0.0])
        for g, k in c.items():
            sums[n][g[:-1]][0] += k
            sums[n][g[:-1]][1] += cuts[n][min(k, 3) - 1]

    def p(g):
        n = len(g)
        lower = p(g[1:]) if n > 1 else 1 / 256
        if g[:-1] not in sums[n]:
            return lower
        whole, loose = sums[n][g[:-1]]
        k = counts[n].get(g, 0)
        return (max(k - cuts[n][min(k, 3) - 1], 0) / whole if k else 0) + loose / whole * lower

    own = grams(t)
    return float(np.exp(-sum(np.log(p(g)) for g in own) / len(own)))


def test_neighbours_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((1200, 24)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 60  # one common vector
    rows = [(k, v) for k, v in enumerate(vectors)] + [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [1.0, None] * 12), (5200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in sorted(neighbours.search(df, every=50, block=200).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    x = np.array(vectors, dtype=np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, len(vectors), 50):
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(len(s)), -np.round(s, 12)))[:5].tolist()
        hits += len(set(best) & {v for v, _ in got[q]})
        assert len(got[q]) == 5 and all(abs(score - s[v]) < 1e-12 for v, score in got[q])
    assert hits / (5 * len(range(0, len(vectors), 50))) >= 0.9 and set(got) == set(range(0, len(vectors), 50))
    assert [v for v, _ in got[0]] == [1200, 1201, 1202, 1203, 1204]
    few = neighbours.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 2), (2, 1)]
    assert neighbours.search(df.limit(0)).count() == 0


def test_neighbours_of_the_embeddings_table(spark):
    """Recall against brute force, and what a query reads of the table."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = collections.defaultdict(set)
    for r in neighbours.search(table).collect():
        got[r["query_id"]].add(r["vec_id"])
    asked = np.flatnonzero(ids % 50 == 0)
    s = unit[asked] @ unit.T
    s[np.arange(len(asked)), asked] = -9
    best = ids[np.argsort(-s, axis=1)[:, :5]]
    assert set(got) == set(ids[asked].tolist())
    assert sum(len(set(b) & got[q]) for q, b in zip(ids[asked].tolist(), best.tolist(), strict=True)) >= 0.9 * best.size


def test_neighbours_of_repeated_ids_and_odd_sizes(spark):
    rows = [(0, [1e200, 0.0]), (0, [1e-300, 1e-302]), (7, [1.0, 1.0]), (7, [1.0, 0.5]), (50, [5e-324, 0.0])]
    df = spark.createDataFrame([(i, v, "a", 3, 4) for i, v in rows], "vec_id long, embedding array<double>, row string, list int, block int")
    got = collections.Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in neighbours.search(df).collect())

    def cosine(a, b):
        a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
        return float(a @ b / np.sqrt((a @ a) * (b @ b)))

    want = collections.Counter()
    for n, (q, v) in enumerate(rows):
        if q % 50 == 0:
            others = sorted(((-cosine(v, w), i) for m, (i, w) in enumerate(rows) if m != n))
            want.update((q, k + 1, i, round(-c, 9)) for k, (c, i) in enumerate(others[:5]))
    assert got == want


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><h1>Head &amp; x</h1><p>one <b>two</b>
three<p>four<br>five<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li hidden>zz</ul><table><tr><th>Name<th>Val<tr><td>long name<td>1<tr><td>x<td>22</table><pre>  a
   b</pre><div style="display: none">no</div><details><summary>S</summary>body</details><script>var a="</p>";</script>a < b<!-- c --> end"""


def test_page_layout():
    assert html_text.render(PAGE).split("\n") == ["Head & x", "", "one two three", "", "four", "five", "", "- a", "- b", "  3. c", "  4. d", "", "Name      | Val", "long name | 1", "x         | 22", "", "  a", "   b", "", "S", "a < b end"]


def test_no_visible_text_is_lost():
    for page, lines in [
        ("<table><tr><form><td>a</td><td>b</td></form></tr><tr><td>c<td>d</table>", ["a | b", "c | d"]),
        ("<table><tr>in row <b>bold</b><td>a</td><form>ask <td>b</td><td hidden>no</td></form></tr><tr>next<td>c</table>", ["in row boldask", "next", "a | b", "c"]),
        ("<table><tr><div><table><tr><td>inner</table></div><td>a</table>", ["inner", "a"]),
        ("x <svg><title>no</title><defs><text>no</text></defs>no<g><text>one <tspan>two</tspan></text><text>three</text><text display=none>no</text></g></svg> y", ["x one two three y"]),
        ("<svg><circle r=1><p>after", ["after"]),
        ("<svg><foreignObject><p>in</p></foreignObject><text>t</text></svg>", ["in", "t"]),
        ("<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>no</annotation></semantics></math> end", ["x=1 end"]),
        ("a<textarea>b &lt;p>\n  c</textarea>d", ["a", "b <p>", "  c", "d"]),
    ]:
        assert html_text.render(page).split("\n") == lines, page


def test_pages_never_fail(spark):
    odd = [None, "", "<", "</", "<<>>", "<p title=\"a>b", "<table><td>x", "<div>" * 4000 + "deep", "<b><table><tr></b><td>q</table>", "<td>alone", "<ul>text<li>item", "<td colspan=0 rowspan=99999>x</td>", "<select><option>a<option selected>b</select>", "&#x110000; &bogus; &amp"]
    df = spark.createDataFrame([(k, h, "clash") for k, h in enumerate(odd)], "page_id long, html string, text string")
    rows = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    assert rows[0] == rows[1] == "" and rows[6] == "x" and rows[7] == "deep" and rows[12] == "b"
    assert html_text.extract(df.limit(0)).count() == 0


def test_visibility_and_cell_text():
    for page, lines in [
        ("<table><tr><td>b |</td></tr><tr><td>||</td><td>||</td></tr></table>", ["b |", "||  | ||"]),
        ("<table><tr><td>a<td>b<tr><td>c<td></table>", ["a | b", "c"]),
        ("<div style='visibility:hidden'>a<b style='visibility:visible'>c</b></div>d\x00e", ["c", "de"]),
        ("<style>.h{display:none} #k.x, i { display : none !important }</style><div class='y h'>a</div>b<span id=k>c</span><span id=k class=x>d</span><i style='display:block'>e</i><p class=h style='display:block'>f", ["bc", "", "f"]),
        ("<style>@media print { p {display:none} } p.q{visibility:hidden}</style><p>a<p class=q>b", ["a"]),
        ("<ol><li>a<li style='display:none'>b<li style='visibility:hidden'>c<li>d</ol>", ["1. a", "3. d"]),
        ("<p>kept<a href=x y='", ["kept"]),
    ]:
        assert html_text.render(page).split("\n") == lines, page


def test_unclosed_markup_takes_linear_time():
    n = 100_000
    began = time.time()
    for page in ("<p>x<a " + 'x="1" ' * n, "<a " * n, '<a b="' * n, "<script>" + "</script " * n, "<!-- " * n, "</" * n, "<p" + " " * n + "x"):
        html_text.render(page)
    assert time.time() - began < 7


class _Plain(html.parser.HTMLParser):
    """Visible text without layout, by the standard library's parser: a second implementation."""

    def __init__(self):
        super().__init__()
        self.out, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.off += 1
        elif tag not in ("a", "b", "i", "em", "span", "code"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.off -= 1
        elif tag not in ("a", "b", "i", "em", "span", "code"):
            self.out.append(" ")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def _plain_words(page):
    parser = _Plain()
    parser.feed(page)
    parser.close()
    return "".join(parser.out).split()


def test_words_equal_a_plain_renderer(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    rng = random.Random(8)

    def made(depth):
        kind = rng.choice(["p", "div", "table", "ul", "b", "text"]) if depth else "text"
        if kind == "text":
            return " ".join(rng.choice(VOCAB) for _ in range(rng.randint(0, 6)))
        if kind == "table":
            return "<table>" + "".join("<tr>" + "".join(f"<td>{made(depth - 1)}" for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 3))) + "</table>"
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{made(depth - 1)}" for _ in range(rng.randint(1, 3))) + "</ul>"
        return f"<{kind}>{made(depth - 1)} {made(depth - 1)}</{kind}>"

    for page in pages + [made(4) for _ in range(200)]:
        got = [w for w in html_text.render(page).split() if w not in ("-", "|")]
        want = [w for w in _plain_words(page) if w not in ("-", "|")]
        # side by side cells of several lines are read line by line: the same words in another order
        assert (got == want) if "<table" not in page else sorted(got) == sorted(want), page
