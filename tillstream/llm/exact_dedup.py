"""Exact de-duplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest: one row per batch
and distinct normalised text, with the row that stays and the number of rows the
batch had of it.  A batch is reduced to one row per digest (partial aggregates,
so a text that makes up a third of the rows is one row per map task), anti-joined
with the index by sort-merge — the index side is read bucket by bucket without a
shuffle — and appended.  The batch's rows then take their keeper from the
resolved digests; those few that hold a large share of the rows are broadcast.

A batch has an identity, by default a digest of its rows.  Index rows of the same
identity are not looked at and not appended again, so a batch that is repeated,
or was stopped after its append, gives the same result as the first time.

Defined cases: null text is the empty text and all empty texts are equal; a
null ``doc_id`` sorts after every id; rows that repeat both id and text are
one document and carry the same flags, also when a later batch brings them again;
an empty batch appends nothing; other columns of the input are ignored (``exact_keep`` passes them through).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank, join_groups, path_exists, same, saved, scratch_path, without_space

LEAST_BUCKETS = 32
BUCKET_ROWS = 4_000_000      # rows of a first batch per bucket of a new index


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_points, text_hash): SHA-256 of the text without ASCII
    white space, the length of the original text in code points and its hash."""
    return docs.select(
        "doc_id", F.xxhash64(blank("text")).alias("text_hash"),
        F.unhex(F.sha2(F.encode(without_space(blank("text")), "UTF-8"), 256)).alias("digest"),
        F.char_length(blank("text")).cast("long").alias("n_points"))


class DigestIndex:
    """Bucketed, sorted digest table at ``path``.

    The bucketing is part of the table's definition, so any session opens the
    same files by path.  ``buckets`` is stored beside the table when it is made
    (``BUCKET_ROWS`` rows of the first batch each unless given) and holds for its
    life; :meth:`copy` writes the index in another number."""

    SCHEMA = "digest BINARY, keep_id {id_type}, keep_points BIGINT, group_size BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int | None = None,
                 rows: int = 0):
        self.spark, self.path, self.id_type = spark, path, id_type
        kept = f"{path}-buckets"
        if not path_exists(spark, f"{kept}/_SUCCESS"):
            n = buckets or max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))
            spark.createDataFrame([(n,)], "buckets INT").coalesce(1).write.mode("overwrite").json(kept)
        self.buckets = spark.read.schema("buckets INT").json(kept).first()[0]
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.SCHEMA.format(id_type=id_type)}) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def read(self, but: str | None = None) -> DataFrame:
        """One row per digest: its keeper and the rows counted so far, without
        those of the batch ``but``.  All rows of a digest name one keeper."""
        rows = self.rows() if but is None else self.rows().filter(F.col("batch") != but)
        return rows.groupBy("digest").agg(
            F.min(F.struct("keep_points", "keep_id")).alias("k"), F.sum("group_size").alias("group_size")).select(
            "digest", F.col("k.keep_id").alias("keep_id"), F.col("k.keep_points").alias("keep_points"), "group_size")

    def append(self, rows: DataFrame, batch: str) -> None:
        """One task per bucket writes one sorted file; what an earlier try of the
        batch has appended stays as it is."""
        own = self.rows().filter(F.col("batch") == batch).select("digest")
        (rows.join(own, "digest", "left_anti")
         .select("digest", "keep_id", "keep_points", "group_size", F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest")
         .write.mode("append").insertInto(self.name))

    def copy(self, path: str, buckets: int) -> DigestIndex:
        """The index anew at ``path`` in ``buckets`` buckets."""
        other = DigestIndex(self.spark, path, self.id_type, buckets)
        self.rows().repartition(buckets, "digest").write.mode("append").insertInto(other.name)
        return other


def batch_identity(keyed: DataFrame) -> str:
    """Number of rows and order-free digest of (id, text digest)."""
    r = keyed.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("doc_id", "digest").cast("decimal(38,0)")).alias("a"),
                  F.sum(F.xxhash64("digest", "doc_id").cast("decimal(38,0)")).alias("b")).first()
    return f"{r['n']}:{r['a']}:{r['b']}"


def batch_groups(keyed: DataFrame) -> DataFrame:
    """One row per digest: the row that stays (most code points, then smallest
    id, null ids last) and the number of rows."""
    # Smallest id of each length first, then the greatest length: both are
    # partial aggregates over slim rows.
    per_length = keyed.groupBy("digest", "n_points").agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    return per_length.groupBy("digest").agg(
        F.max(F.struct("n_points", "id")).alias("top"), F.sum("n").alias("group_size")).select(
        "digest", F.col("top.id").alias("keep_id"), F.col("top.n_points").alias("keep_points"),
        "group_size")


def add_batch(docs: DataFrame, index_path: str, buckets: int | None = None,
              batch: str | None = None) -> DataFrame:
    """De-duplicate ``docs`` against the index at ``index_path`` and within
    itself, append its digests and return (doc_id, text_hash, keep_id,
    group_size, kept, digest) per row.

    ``group_size`` counts the rows of this batch and of all other batches in the
    index; the keeper of a digest that these have stays theirs.  ``batch`` names
    the batch where the caller has a name for it."""
    spark = docs.sparkSession
    keyed = saved(digests(docs), "digests")
    index = DigestIndex(spark, index_path, docs.schema["doc_id"].dataType.simpleString(), buckets, keyed.count())
    batch = batch or batch_identity(keyed)
    groups = saved(batch_groups(keyed), "digest-groups")
    known = index.read(but=batch)
    fresh = groups.join(known, "digest", "left_anti").withColumn("old_size", F.lit(0).cast("long"))
    old = groups.select("digest", "group_size").join(
        known.withColumnRenamed("group_size", "old_size"), "digest")
    resolved = saved(fresh.unionByName(old), "digest-resolved")
    index.append(resolved, batch)
    return join_groups(keyed, resolved, "digest", "group_size", keyed.count()).select(
        "doc_id", "text_hash", "keep_id", (F.col("group_size") + F.col("old_size")).alias("group_size"),
        (same(F.col("doc_id"), F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))).alias("kept"),
        "digest")


def exact_dedup(docs: DataFrame, index_path: str | None = None, buckets: int | None = None,
                batch: str | None = None) -> DataFrame:
    """:func:`add_batch` on the index at ``index_path`` (a new one when None)."""
    return add_batch(docs, index_path or scratch_path(docs.sparkSession, "digest-index"), buckets, batch)


def exact_keep(docs: DataFrame, index_path: str | None = None, buckets: int | None = None,
               batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Of kept rows
    that differ in white space only, the one with the smallest text hash stays;
    of rows that repeat both id and text, any one.

    Only the names (id, text hash) of the rows that go are joined with the
    texts, so texts are not moved when these are few enough to broadcast."""
    rows = saved(exact_dedup(docs, index_path, buckets, batch), "dedup-rows")
    first = rows.filter("kept").groupBy("digest").agg(F.min("text_hash").alias("first_hash"))
    stays = F.col("kept") & (F.col("text_hash") == F.col("first_hash"))
    judged = rows.join(first, "digest", "left").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"),
        F.coalesce(stays, F.lit(False)).alias("__stays"))
    names = judged.groupBy("__id", "__hash").agg(F.max("__stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    names = saved(names, "dedup-names")
    own = docs.withColumn("__own", F.xxhash64(blank("text")))
    by_name = lambda t: same(own["doc_id"], t["__id"]) & (own["__own"] == t["__hash"])
    gone = names.filter("not stays").select("__id", "__hash")
    repeated = names.filter("stays and n > 1").select("__id", "__hash")
    if not repeated.limit(1).count():
        return own.join(gone, by_name(gone), "left_anti").select(*docs.columns)
    away = gone.unionByName(repeated)
    once = own.join(repeated, by_name(repeated), "left_semi").dropDuplicates(["doc_id", "__own"])
    return own.join(away, by_name(away), "left_anti").unionByName(once).select(*docs.columns)
