"""Token counts behind a digest cache.

The cache is a Parquet folder of (content digest, tokenizer-version digest,
n_tokens).  Documents are joined to it by digest; only distinct digests that
the cache lacks are encoded, each once, and appended.  Contents are normalised
before digesting by what the tokenizer itself drops: runs of ASCII white space
become one space and the ends are trimmed.

Defined cases: null text counts as empty and has no tokens; repeated rows are
each returned; a null ``doc_id`` is kept; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank, same, saved, scratch_path, slices
from .tokens import DEFAULT_VOCABULARY, encoder, tokenizer_version, without_cycles

OVER = 2048


def content_digest() -> Column:
    text = F.trim(F.regexp_replace(blank("text"), r"[\x20\x09-\x0D]+", " "))
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


class TokenCountCache:
    """Stored counts under ``path``; one folder per tokenizer version."""

    def __init__(self, spark: SparkSession, path: str, vocabulary: str = DEFAULT_VOCABULARY):
        self.spark, self.vocabulary = spark, vocabulary
        self.version = tokenizer_version(vocabulary)
        self.path = f"{path}/tokenizer={self.version}"
        # An empty part makes the folder readable before the first append.
        spark.createDataFrame([], "digest BINARY, n_tokens BIGINT").write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """One count per digest, also when two jobs appended the same one."""
        rows = self.spark.read.schema("digest BINARY, n_tokens BIGINT").parquet(self.path)
        return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def misses(self, docs: DataFrame) -> DataFrame:
        """Distinct digests without a stored count, each with one document that
        has it: (digest, doc_id)."""
        wanted = (docs.select("doc_id", content_digest().alias("digest"))
                  .groupBy("digest").agg(F.min("doc_id").alias("doc_id")))
        return wanted.join(self.read(), "digest", "left_anti")

    def fill(self, docs: DataFrame) -> None:
        """Encode every distinct miss once and append the counts.  The text of
        one document per miss moves; its key is the document, so copies of one
        text never meet in a task."""
        missing = saved(self.misses(docs), "token-misses")
        own = docs.select(F.col("doc_id").alias("__id"), content_digest().alias("__digest"),
                          F.encode(blank("text"), "UTF-8").alias("raw"))
        texts = own.join(missing, same(own["__id"], missing["doc_id"])
                         & (own["__digest"] == missing["digest"])).select("digest", "raw")
        counts = texts.mapInArrow(_counter(self.vocabulary), "digest BINARY, n_tokens BIGINT")
        counts.write.mode("append").parquet(self.path)


def _counter(vocabulary: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in (part for batch in batches for part in slices(batch)):
            with without_cycles():
                n = [len(enc.ids(t)) // 4 for t in b.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())],
                                             ["digest", "n_tokens"])
    return count


def count_tokens(docs: DataFrame, cache_path: str | None = None,
                 vocabulary: str = DEFAULT_VOCABULARY, over: int = OVER) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, through the cache
    at ``cache_path`` (a new one when None)."""
    spark = docs.sparkSession
    cache = TokenCountCache(spark, cache_path or scratch_path(spark, "token-cache"), vocabulary)
    cache.fill(docs)
    counted = saved(cache.read(), "token-counts")
    own = docs.select("doc_id", F.octet_length(blank("text")).cast("long").alias("n_bytes"),
                      content_digest().alias("digest"))
    return own.join(counted, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
