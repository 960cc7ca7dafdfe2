"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import (
    best_fit_packing,
    divergence_audit,
    importance_resampling,
    licence_scan,
    line_dedup,
    line_frequency,
    mincut_extraction,
    prefix_forest,
    rule_ensemble,
    secret_scan,
    sentencepieces,
    simhash_tiles,
    token_counts,
)
from sparkmart.llm.common import table


def op1_mincut_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut_extraction.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = prefix_forest.nearest(vectors, k=5, every=50)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_frequency.judge(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_tiles.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return best_fit_packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), path)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), path)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.token_digests(table(spark, sf_dir, "documents", "doc_id", "text"), path)


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return rule_ensemble.quality_scores(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit.audit(table(spark, sf_dir, "documents", "text", "lang", "source"), least=30, k=50)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return importance_resampling.resample(docs, table(spark, sf_dir, "benchmark", "text"), percent=10, least=20, n=1, buckets=10_000, seed=2024)


def op13_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.scan_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    name: query for name, query in globals().items() if name.startswith("op") and name[2:3].isdigit()
}
