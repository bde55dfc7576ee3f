"""Language of a text whatever stands next to it, pages with many rules and wide tables, and scratch folders of runs side by side."""

from __future__ import annotations

import os
import random
import threading
import time

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from trajlake.llm import html_text, language, substring_dedup, token_files, workspace

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def _alone(text: str, m: language.Model) -> tuple[str, float]:
    """Language and score of one text by the definition, byte by byte."""
    raw = text.encode()
    fold = [32 if b < 128 and not chr(b).isalpha() else b | 32 if b < 128 else b for b in raw] + [32] * 3
    total = np.zeros(m.codes.shape[1])
    for k in range(len(raw)):
        key = sum(fold[k + j] << (8 * j) for j in range(4))
        total += m.weights[(key * 2654435761 % (1 << 32)) >> 18]
    unit = np.clip(total / len(raw) / m.scale, -3, 3)
    loss = (np.exp(-unit * m.codes) * m.scale).sum(axis=1) / m.scale.sum()
    share = np.exp(-4 * (loss - loss.min()))
    share /= share.sum()
    return m.languages[int(share.argmax())], float(share.max())


def test_prediction_equals_the_definition_text_by_text(spark, model):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect() if r["text"] and any(c.isalpha() for c in r["text"])]
    texts = [t[:n] for t in texts for n in (3, 40, 400)] + ["the", "zzzz qqqq", "é", "a", "Ünd 12"]
    texts = [t for t in texts if any(c.isalpha() for c in t)]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), model).collect()}
    for k, t in rows:
        name, score = _alone(t, model)
        assert abs(got[k]["score"] - score) < 1e-6 and (got[k]["lang_pred"] == name or got[k]["score"] - 0.5 < 0.01), t


def test_neighbours_order_and_partitions_change_nothing(spark, model):
    rng = random.Random(2)
    words = ["the", "zzzz qqqq", "", None, "a", "le", "und", "xx" * 50, "1 2 3", "é", "the"]
    rows = [(k, rng.choice(words)) for k in range(300)]
    seen = set()
    for parts in (1, 4, 9):
        rng.shuffle(rows)
        got = language.predict(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), model).collect()
        seen.add(tuple(sorted((r["doc_id"], r["lang_pred"], r["score"], r["second"]) for r in got)))
        of = {}
        for r in got:
            of.setdefault(dict(rows)[r["doc_id"]], set()).add((r["lang_pred"], r["score"]))
        assert all(len(v) == 1 for v in of.values())
    assert len(seen) == 1
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, other = language.fit(docs.coalesce(1)), language.fit(docs.repartition(6).orderBy(F.rand(1)))
    assert (one.weights == other.weights).all() and one.languages == other.languages


def test_many_style_rules_take_linear_time():
    n = 20_000
    for css in (".a{display:block}" * n, "".join(f".a.b{k}{{display:block}}" for k in range(n)), "".join(f".b{k}{{display:none}}" for k in range(n))):
        page = f"<style>{css}</style>" + "".join(f"<p class='a c{k}'>x" for k in range(n))
        began = time.time()
        assert html_text.render(page).count("x") == n
        assert time.time() - began < 6  # below one second on a machine that does nothing else


def test_merged_rules_keep_the_strongest():
    for css, seen in [
        ("p{display:none}p{display:block}", True), ("p{display:block}p{display:none}", False), ("p{display:none!important}p{display:block}", False),
        (".a{display:none}p{display:block}", False), ("p.a{display:block}.a{display:none}", True), ("#i{display:block}.a.b{display:none}", True),
        (".a{visibility:hidden}.a{display:block}", False), (".b.a{display:none}.a.b{display:block}", True),
    ]:
        assert (html_text.render(f"<style>{css}</style><p class='a b' id=i>x") == "x") is seen, css


def test_tables_are_padded_within_a_multiple_of_the_page():
    pages = ["<table><tr><td>" + "w" * 200_000 + "<td>b</tr>" + "<tr><td>a<td>b" * 300 + "</table>", "<table><tr>" + "<td>q" * 1000 + "<tr><td colspan=999>x<td>y" * 2000 + "</table>"]
    nest = ""
    for _ in range(40):
        nest = f"<table><tr><td>{'a' * 60}<td>b<tr><td>c<td>{nest}</table>"
    for page in [*pages, nest]:
        text = html_text.render(page)
        assert len(text) <= (html_text.PADDING + 2) * len(page)
    assert html_text.render(pages[0]).split("\n")[1] == "a | b"
    assert html_text.render("<table><tr><td>long cell<td>b<tr><td>a<td>c</table>") == "long cell | b\na         | c"


@pytest.fixture()
def root(tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "_root", lambda spark: f"file://{tmp_path}/trajlake")
    return tmp_path / "trajlake"


def test_runs_leave_their_result_alone_and_do_not_disturb_each_other(spark, root):
    one = corpus_pipeline.run(spark, SF)
    assert len(list(root.iterdir())) == 1
    other = corpus_pipeline.run(spark, SF)
    assert len(list(root.iterdir())) == 2
    assert one.count() == other.count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (corpus_pipeline.repeated_passages(spark, docs.where(f"doc_id % 2 = {k}"), SF) for k in (0, 1))
    assert b.count() + a.count() == docs.count()
    counts = {}

    def work(k: int) -> None:
        with workspace.scratch(spark):
            counts[k] = substring_dedup.remove(docs.where(f"doc_id % 2 = {k}")).count()

    threads = [threading.Thread(target=work, args=(k,)) for k in (0, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(counts.values()) == docs.count()


def test_scratch_is_deleted_also_after_a_failure_and_kept_tables_stay(spark, root):
    def files() -> int:
        return len(list(root.rglob("*.parquet")))

    with workspace.scratch(spark):
        gone = workspace.written(spark.range(3))
        with workspace.scratch(spark):
            inner = workspace.kept(spark.range(4))
        stays = workspace.kept(inner)
        assert gone.count() == 3
    assert stays.count() == 4 and files() == len(stays.inputFiles())
    with pytest.raises(ZeroDivisionError), workspace.scratch(spark):
        workspace.written(spark.range(5))
        raise ZeroDivisionError
    assert files() == len(stays.inputFiles())


def test_token_files_by_ranges_and_with_every_id(spark, tmp_path):
    store = pafs.SubTreeFileSystem("/", pafs.LocalFileSystem())  # not known as a local store
    values = np.arange(10_000, dtype="<i8") * 3
    (tmp_path / "x.idx").write_bytes(values.tobytes())
    for s in (store, pafs.LocalFileSystem()):
        m = token_files.Mapped(s, str(tmp_path / "x.idx"), "<i8")
        assert len(m) == 10_000 and m.local is (s is not store)
        for some in (slice(0, 5), slice(9_998, 10_050), slice(4096, 8193), slice(7, 7)):
            assert m[some].tolist() == values[some].tolist()
    rows = [(None, "a"), (-(1 << 63), "b b"), (0, ""), (None, None), ((1 << 63) - 1, "c"), (0, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_files.read(spark, token_files.bases(token_files.write(df, public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49_408))).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((d is None, d or 0) for d, _ in rows)
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [None, None, -(1 << 63), 0, 0, (1 << 63) - 1]
