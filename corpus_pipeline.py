"""Corpus pipeline: language ID, quality classifier, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame;
between stages the rows are written as Parquet and read again. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm import jaccard_join, language, packing, perplexity, substring_dedup
from trajlake.llm.workspace import delete, kept, scratch, shared_dir, written

#: Rows of ids that may be copied to every task; more are joined by shuffle.
FEW_IDS = 2_000_000


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same columns under names that no operator uses, and each column's."""
    names = {c: f"own_{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter and those whose language stays ambiguous between two codewords."""
    model = language.fit(docs)
    plain, names = _plain(docs)
    named = language.predict(plain, model, id_col=names["doc_id"], text_col=names["text"], carry=list(names.values()))
    return named.where("lang_pred <> 'und' and not ambiguous").select(*names.values()).toDF(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents whose perplexity lies beyond their language's threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return perplexity.classify(docs, labels, carry=docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near copies, and one of rows with one id and text."""
    with scratch(spark):
        extra = kept(jaccard_join.join(docs).where("component_id <> doc_id").select("doc_id"))
    plain, names = _plain(docs)
    own, text = names["doc_id"], names["text"]
    left = plain.join(_few(extra), F.col(own) == F.col("doc_id"), "left_anti")
    again = written(left.groupBy(own).agg(F.count("*").alias("n")).where("n > 1").select(F.col(own).alias("again")))
    if again.isEmpty():
        return left.toDF(*docs.columns)
    same = F.col(own).eqNullSafe(F.col("again"))
    twice = left.join(_few(again), same, "left_semi").dropDuplicates([own, text])
    return left.join(_few(again), same, "left_anti").unionByName(twice).toDF(*docs.columns)


def _few(ids: DataFrame) -> DataFrame:
    """Copied to every task only if they are few."""
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that occur elsewhere; a document keeps its row, with the words that are left."""
    plain, names = _plain(docs)
    carried = [n for c, n in names.items() if c not in ("text", "n_chars")]
    cut = substring_dedup.remove(plain, id_col=names["doc_id"], text_col=names["text"], carry=carried)
    return cut.select(*[F.col("text") if c == "text" else F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(names[c]).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: SQL can express neither the classifiers nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again.

    Of what a stage wrote on its way nothing stays once its output stands, and of the outputs only the last.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, step in STAGES:
        path = shared_dir(spark)
        with scratch(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
