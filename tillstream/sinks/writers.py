"""Writers (SNK-1 … SNK-8, SNK-11).

Every streaming sink may be replayed: appends go to a folder named by the
query and the batch id (rewritten whole on replay), and a keyed table keeps the
greatest version of a key, so a batch that runs twice, or half, changes nothing.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.cdc import latest_per_key
from tillstream.session import materialize


def to_json_value(df: DataFrame, cols: Sequence[str] | None = None,
                  drop: Sequence[str] = ()) -> DataFrame:
    """SNK-1 value column: the row (minus ``drop`` — bean fields marked not
    serialisable) as JSON text."""
    keep = [c for c in (cols or df.columns) if c not in drop]
    return df.select(F.to_json(F.struct(*keep)).alias("value"))


def serialize(df: DataFrame, value: Callable[[DataFrame], object],
              key: Callable[[DataFrame], object] | None = None,
              topic: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """SNK-3: caller-supplied serialiser as column builders for key / value / topic."""
    cols = [F.lit(None).cast("string").alias("key") if key is None else key(df).alias("key"),
            value(df).alias("value")]
    if topic is not None:
        cols.append(topic(df).alias("topic"))
    return df.select(*cols)


def write_json(df: DataFrame, path_or_topic: str, bootstrap_servers: str | None = None,
               mode: str = "append") -> None:
    """SNK-1 / SNK-8 (batch): JSON messages to a Kafka topic, or JSON files."""
    if bootstrap_servers:
        (to_json_value(df).write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", path_or_topic).save())
    else:
        df.write.mode(mode).json(path_or_topic)


def write_routed(df: DataFrame, topic_col: str, path: str | None = None,
                 bootstrap_servers: str | None = None, mode: str = "append") -> None:
    """SNK-2: each row to the output named by ``topic_col`` (Kafka ``topic``
    column, or one folder per value)."""
    if bootstrap_servers:
        out = df.select(F.col(topic_col).alias("topic"),
                        F.to_json(F.struct(*[c for c in df.columns if c != topic_col])).alias("value"))
        out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()
    else:
        df.write.mode(mode).partitionBy(topic_col).json(path)


def query_id(df: DataFrame) -> str:
    """Id of the streaming query whose micro-batch ``df`` is (it lives in the
    query's checkpoint, so a restarted query keeps it and a new one has its
    own); ``batch`` outside of a stream."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def write_batch_append(df: DataFrame, base: str, batch_id: int, fmt: str = "parquet",
                       query: str | None = None, partition_by: Sequence[str] = ()) -> str:
    """SNK-5: one micro-batch appended under ``query=<id>/batch=<id>``: a replay
    rewrites its own folder, and a job with a new checkpoint, whose batch ids
    begin at 0 again, never touches what an earlier one wrote.  ``partition_by``
    adds folders of column values below (``ds``)."""
    target = os.path.join(base, f"query={query or query_id(df)}", f"batch={batch_id}")
    df.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(target)
    return target


TOMBSTONE = "__deleted"
BUCKET_ROWS = 4_000_000      # rows a bucket of a new keyed table is meant for


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; a store that cannot be read raises."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _done(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was finished."""
    return _exists(spark, os.path.join(path, "_SUCCESS"))


def _rows(spark: SparkSession, base: str) -> DataFrame | None:
    """All rows of a keyed table with their ``bucket``; None before its first
    batch.  A table that exists but cannot be read raises."""
    if not _done(spark, os.path.join(base, "properties")):
        return None
    return spark.read.parquet(os.path.join(base, "data"))


def _buckets(spark: SparkSession, base: str) -> int:
    return spark.read.schema("buckets INT").json(os.path.join(base, "properties")).first()[0]


def current_table(spark: SparkSession, base: str, tombstones: bool = False) -> DataFrame | None:
    """The image of a keyed table (deleted keys hidden); None before the first
    batch."""
    df = _rows(spark, base)
    if df is None:
        return None
    df = df.drop("bucket")
    return df if tombstones else df.where(~F.coalesce(F.col(TOMBSTONE), F.lit(False))).drop(TOMBSTONE)


def upsert_table(spark: SparkSession, base: str, batch: DataFrame, keys: Sequence[str],
                 order: Sequence[str], delete_col: str | None = None, buckets: int | None = None) -> None:
    """SNK-4 / SNK-6 / SNK-7: merge a batch of changes into a keyed table of
    Parquet files in ``buckets`` folders (fixed when the table is made; by
    default sized to the first batch, ``BUCKET_ROWS`` each; :func:`rebucket`
    changes it).

    The batch and the rows of the buckets it touches compete in one aggregate,
    the greatest version of a key wins, deletes stay as tombstones: merging a
    batch twice, or an older one later, changes nothing, so no record of batches
    is needed.  The merged buckets are written to ``pending`` and then, in one
    job, over the old ones; a write that died between is found in ``pending``
    and merged again by the next call.  A table has one writer at a time (a
    streaming query); where several write, use a table format's ``MERGE``."""
    pending = os.path.join(base, "pending")
    rows = batch.withColumnRenamed(delete_col, TOMBSTONE) if delete_col else batch.withColumn(TOMBSTONE, F.lit(False))
    if _done(spark, pending):
        rows = materialize(rows.unionByName(spark.read.parquet(pending).drop("bucket"), allowMissingColumns=True),
                           "upsert-again")
    known = _rows(spark, base)
    if known is None:
        n = buckets or max(1, -(-rows.count() // BUCKET_ROWS))
    else:
        n = _buckets(spark, base)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
    if known is not None:
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]    # at most n
        if not touched:
            return
        rows = rows.unionByName(known.where(F.col("bucket").isin(touched)), allowMissingColumns=True)
    merged = latest_per_key(rows, [*keys, "bucket"], order)
    merged.repartition("bucket").write.mode("overwrite").parquet(pending)
    (spark.read.parquet(pending).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(os.path.join(base, "data")))
    if known is None:
        spark.createDataFrame([(n,)], "buckets INT").coalesce(1).write.mode("overwrite").json(
            os.path.join(base, "properties"))
    fs, p = _fs(spark, pending)
    fs.delete(p, True)


def rebucket(spark: SparkSession, base: str, target: str, keys: Sequence[str], buckets: int) -> None:
    """A copy of a keyed table in another number of buckets, under ``target``."""
    rows = current_table(spark, base, tombstones=True)
    (rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(target, "data")))
    spark.createDataFrame([(buckets,)], "buckets INT").coalesce(1).write.mode("overwrite").json(
        os.path.join(target, "properties"))


def foreach_batch_writer(fn: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Wrap a ``(df, batch_id)`` writer for ``writeStream.foreachBatch``."""
    def run(df: DataFrame, batch_id: int) -> None:
        fn(df, batch_id)
    return run


def kept_once(df: DataFrame, fn: Callable[[DataFrame], None]) -> None:
    """Run ``fn`` on rows that several outputs read: computed once (SPL-1)."""
    df.persist()
    try:
        fn(df)
    finally:
        df.unpersist()


def console(df: DataFrame, checkpoint: str):
    """SNK-11: print a stream (debugging)."""
    return (df.writeStream.format("console").option("truncate", "false")
            .option("checkpointLocation", checkpoint).outputMode("append").start())
