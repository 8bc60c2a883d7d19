"""One thin query per corpus operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    exact_dedup,
    fill_in_middle,
    language_id,
    license_scan,
    lm_score,
    near_dup,
    packing,
    quality,
    simhash,
    token_align,
    token_counts,
    url_reputation,
)
from .common import same, table
from .oracles import ORACLE  # noqa: F401


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, as this query's contract says."""
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id",
                        same(F.col("doc_id"), F.col("component_id")).alias("kept"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled outcome of a page is the quality label of the same id."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 1).alias("good"))
    return url_reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes).select(
        "page_id", "host", "path", "rule", "verdict")


def _sha256(text) -> Column:
    """Lowercase hex over the UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups are digested where they are made; their texts are not stored."""
    rows = token_align.aligned(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, _sha256("groups")).otherwise("").alias("groups_sha256")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"]
    return token_align.link_scores(token_align.numbered(rows.select(*kept))).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       _sha256("output").alias("output_sha256"), _sha256(again).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_token_counts, op3_best_fit_packing, op4_license_scan, op5_lm_scores,
    op6_exact_dedup, op7_language_id, op8_minhash_near_dup, op9_quality_classifier, op10_url_reputation,
    op11_token_alignment, op12_simhash_near_dup, op13_fill_in_middle)}
