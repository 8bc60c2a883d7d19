"""Run summary and failed ids (AGG-11, TOP-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def smallest_k(df: DataFrame, group: list[str], value: str, k: int, salt: int = 64) -> DataFrame:
    """The ``k`` smallest ``value`` per group, as a sorted array.

    Two exact phases: first the ``k`` smallest within each (group, salt) slice,
    then the ``k`` smallest of those ≤ ``k × salt`` candidates.  A group holding
    a large share of the rows is thus ranked by ``salt`` tasks, and no step
    collects more than ``k × salt`` values per group."""
    s = df.select(*group, value).withColumn("_salt", F.abs(F.xxhash64(value)) % salt)
    w1 = Window.partitionBy(*group, "_salt").orderBy(value)
    cand = s.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(*group).orderBy(value)
    top = cand.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= k)
    return top.groupBy(*group).agg(F.array_sort(F.collect_list(value)).alias(f"first_{k}"))


def failed_ids(df: DataFrame, group: list[str], ok: str, id_col: str) -> DataFrame:
    """AGG-11: every failed id, one row each."""
    return df.where(~F.col(ok)).select(*group, F.col(id_col).alias("failed_id"))


def run_summary(df: DataFrame, group: list[str], ok: str, ts_ms: str, id_col: str | None = None,
                show: int | None = None) -> DataFrame:
    """AGG-11: successes, failures, first start, last end and duration in
    seconds per group.  ``show`` adds the first ids that failed as a text of at
    most that many, for a message; the full list is :func:`failed_ids`."""
    agg = df.groupBy(*group).agg(
        F.sum(F.col(ok).cast("int")).alias("n_success"),
        F.sum((~F.col(ok)).cast("int")).alias("n_fail"),
        F.min(ts_ms).alias("start_ms"), F.max(ts_ms).alias("end_ms"))
    agg = agg.withColumn("duration_s", F.expr("(end_ms - start_ms) div 1000"))
    if show is None:
        return agg
    firsts = smallest_k(df.where(~F.col(ok)), group, id_col, show)
    return agg.join(firsts, group, "left").select(*agg.columns, F.coalesce(
        F.array_join(F.col(f"first_{show}").cast("array<string>"), ","), F.lit("")).alias("failed_ids"))
