"""A training-corpus pipeline over ``documents``.

Five stages, each one of the corpus operators: documents that the quality
classifier rejects go, one document of each exact and each near-duplicate group
stays, documents that contain a benchmark item go, and what is left is packed
into token sequences.  Every stage works on all that its predecessor kept; its
result is written as Parquet and reread as the next stage's ``docs``.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import decontaminate, exact_dedup, near_dup, packing, quality
from tillstream.llm.common import saved, table
from tillstream.session import ship_package


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return exact_dedup.exact_keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_dup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("best-fit packing", pack_sequences),
]

# The classifier's score and the tokenizer have no SQL form; tests/llm holds
# the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
