"""The pipeline's stages on a small table, each held against what it must keep."""

from __future__ import annotations

import os
import random

import corpus_pipeline
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages_keep_clean_documents_and_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if k == len(corpus_pipeline.STAGES) - 1:
            assert after.agg({"length": "sum"}).first()[0] > 0
            assert after.select("doc_id").distinct().count() == docs.count()
            break
        assert after.columns == columns
        if name == "language_id":
            assert after.count() >= 0.98 * docs.where("text rlike '[a-zA-Z]'").count()
        if name == "quality_classifier":
            good = labels.where("quality = 1").join(docs, "doc_id")
            assert good.join(after, "doc_id", "left_semi").count() >= 0.97 * good.count()
            bad = labels.where("quality = 0").join(docs, "doc_id")
            assert bad.join(after, "doc_id", "left_semi").count() <= 0.3 * bad.count()
        if name == "near_duplicates":
            assert after.count() == after.select("doc_id").distinct().count() < docs.count()
        if name == "repeated_passages":
            assert after.count() == docs.count()
        docs = after


def test_an_empty_table_passes_through(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0


def test_mixed_and_foreign_documents_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng, by = random.Random(1), {}
    for r in docs.where("n_chars > 200").orderBy("doc_id").collect():
        by.setdefault(r["lang"], []).append(r["text"][:150])
    mixed = [(10**9 + k, " ".join(rng.choice(by[lang]) for lang in rng.sample(sorted(by), 2))) for k in range(100)]
    foreign = ["De kat zit op de mat en kijkt naar de vogels in de tuin.", "Mačka sjedi na prostirci i gleda ptice u vrtu.", "Kissa istuu matolla ja katselee lintuja puutarhassa.", "Danas je lijepo vrijeme i idemo na plažu."]
    planted = spark.createDataFrame(mixed + [(2 * 10**9 + k, t) for k, t in enumerate(foreign)], "doc_id long, text string")
    after = corpus_pipeline.language_id(spark, docs.unionByName(planted, allowMissingColumns=True), SF)
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    assert sum(k in kept for k, _ in mixed) <= 75
    assert not any(2 * 10**9 + k in kept for k in range(len(foreign)))
    assert sum(k < 10**9 for k in kept) >= 0.98 * docs.where("text rlike '[a-zA-Z]'").count()


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    """Nulls in every column, repeated rows, long texts and columns named as the operators name theirs."""
    clash = "score double, lang_pred string, own_0 int, n_words int, n_removed int, piece int, quality_kept boolean, kept int, component_id int, fp int, n int, length int, again int, c_0 int, trusted boolean, threshold double"
    names = [c.split()[0] for c in clash.split(", ")]
    base = spark.read.parquet(f"{SF}/documents.parquet")
    long = base.where("n_chars > 100").orderBy("doc_id").first()
    odd = [(10**9, None, "en", "a", 1), (None, long["text"] + " x", "en", "a", 1), (None, long["text"] + " x", "en", "a", 1), (10**9 + 1, "", None, None, None), (10**9 + 2, long["text"] * 300, long["lang"], None, 5), (10**9 + 3, long["text"] + " end", None, "b", None), (10**9 + 3, long["text"] + " end", None, "b", None)]
    docs = base.unionByName(spark.createDataFrame(odd, base.schema))
    docs = docs.unionByName(base.where("doc_id % 7 = 0")).select("*", *[F.expr(f"cast(if(doc_id % 2 = 0, 1, null) as {c.split()[1]})").alias(c.split()[0]) for c in clash.split(", ")])
    docs.write.parquet(str(tmp_path / "start"))
    docs = spark.read.parquet(str(tmp_path / "start"))
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if k == len(corpus_pipeline.STAGES) - 1:
            assert after.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
            break
        assert after.columns == columns and [t for _, t in after.dtypes] == [t for _, t in docs.dtypes]
        assert after.where("doc_id % 2 = 0").count() == after.where(" and ".join(f"{c} is not null" for c in names)).count() > 0
        if name == "near_duplicates":
            assert after.count() == after.select("doc_id", "text").distinct().count()
        docs = after
