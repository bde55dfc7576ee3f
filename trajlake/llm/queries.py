"""Queries opN_<name>: each applies one operator to its whole table and returns its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm import best_position, byte_bpe, drift_clusters, html_text, jaccard_join, language, neighbours, oracle, packing, perplexity, quality_rules, substring_dedup, token_files, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = _read(spark, sf_dir, "documents").withColumn("held_out", held_out)
    model = language.fit(docs.where("not held_out"))
    return language.predict(docs, model, carry=["held_out"])


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49_408)
    return token_files.read(spark, token_files.bases(manifest))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_read(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_read(spark, sf_dir, "embeddings"))


def op11_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read(warc.write(_read(spark, sf_dir, "pages")), payloads=False)

    def page(name: str) -> Column:
        return F.regexp_extract(name, r"^urn:trajlake:page:(-?\d+|none):", 1).try_cast("long")

    return found.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"), "issue")


def op13_drift_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_clusters.cluster(_read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_text": op1_html_text,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_language_id": op3_language_id,
        "op4_packing": op4_packing,
        "op5_token_files": op5_token_files,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_quality_rules": op7_quality_rules,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_neighbours": op10_neighbours,
        "op11_best_position": op11_best_position,
        "op12_warc": op12_warc,
        "op13_drift_clusters": op13_drift_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
