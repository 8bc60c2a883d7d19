"""First-visit and sequence logic (SEQ-1 … SEQ-7), batch forms.

The streaming jobs keep one value per key in state and compare each arriving
row with it.  On a batch that is ordered by ``(ts, tie-break)`` the same flags
follow from per-key *aggregates* instead of per-key sorts:

* "date differs from the last stored date" ⇔ the row is the first of its
  ``(key, date)`` group;
* the anchor of the new-visitor repair is a property of the key's first row.

Retractions (SEQ-7) need to know which row of an id is its last: rows are ranked
within (id, minute), and only the last of each minute are compared across
minutes, so an id with a third of all rows is spread over its time span.

Aggregates get a map-side partial step, so a key that holds a third of all
rows never lands whole in one task; joins back to the rows are equi-joins that
AQE splits when skewed.  Where an ordered scan is still needed (previous login
date) it runs over one row per ``(key, day)``, which is bounded by the
calendar, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.dates import ms_to_date
from tillstream.functions.text import _c, empty_or_null


def first_rows(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str],
               keep: Sequence[str]) -> DataFrame:
    """One row per key: the ``keep`` columns of the row that is smallest by
    ``order``: a partial and a final aggregate.  Structs and strings make Spark
    sort within each task; a single ``min(ts)`` (see ``daily_firsts``) hashes."""
    key_cols = [_c(k) for k in keys]
    pick = F.min_by(F.struct(*[F.col(c) for c in keep]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*key_cols).agg(pick.alias("_first")).select(*key_cols, "_first.*")


def daily_firsts(df: DataFrame, key: str, ts: str, tiebreak: str,
                 keep: Sequence[str]) -> DataFrame:
    """First row of each (key, day) — the rows that carry a daily-unique 1."""
    d = df.withColumn("_day", ms_to_date(ts))
    if not keep:
        return d.groupBy(key, F.col("_day").alias("day")).agg(F.min(ts).alias(ts))
    return first_rows(d, [key, "_day"], [ts, tiebreak], [ts, *keep]).withColumnRenamed("_day", "day")


def returning_users(logins: DataFrame, key: str = "uid", ts: str = "ts",
                    tiebreak: str = "log_id", min_days: int = 8) -> DataFrame:
    """SEQ-5: one row per (key, day) with ``uu_ct`` = 1 and ``back_ct`` = 1 when
    whole days from the previous login day's midnight to this login reach
    ``min_days``.  The ordered step runs over one row per (key, day)."""
    firsts = daily_firsts(logins, key, ts, tiebreak, [])
    w = Window.partitionBy(key).orderBy("day")
    prev_day = F.lag("day").over(w)
    prev_midnight = F.unix_millis(F.to_timestamp(prev_day))
    gap = F.floor((F.col(ts) - prev_midnight) / F.lit(86_400_000))
    return firsts.select(
        key, "day", ts, F.lit(1).alias("uu_ct"),
        F.when(prev_day.isNotNull() & (gap >= min_days), 1).otherwise(0).alias("back_ct"))


def repair_is_new(log: DataFrame, tiebreak: str = "log_id") -> DataFrame:
    """SEQ-6 new/old visitor flag repair.

    The anchor day of a device is the day of its first log when that log says
    ``is_new = '1'``, otherwise the day before.  Any later ``is_new = '1'`` on a
    different day is rewritten to ``'0'``.
    """
    d = log.select("*", F.col("common.mid").alias("_mid"))
    first = first_rows(d, ["_mid"], ["ts", tiebreak], ["ts", "common"]).select(
        "_mid",
        F.when(F.col("common.is_new") == "1", F.to_date(ms_to_date("ts")))
         .otherwise(F.date_sub(F.to_date(ms_to_date("ts")), 1)).alias("_anchor"))
    j = d.join(first, "_mid", "left")
    fix = (F.col("common.is_new") == "1") & (F.to_date(ms_to_date("ts")) != F.col("_anchor"))
    return (j.withColumn("common", F.col("common").withField(
                "is_new", F.when(fix, F.lit("0")).otherwise(F.col("common.is_new"))))
             .drop("_mid", "_anchor"))


VERSION_BUCKET_MS = 60_000


def with_latest(df: DataFrame, key: str, order: Sequence[str], flag: str = "_last",
                bucket_ms: int = VERSION_BUCKET_MS) -> DataFrame:
    """``df`` + whether a row is the last of its ``key`` by ``order`` (a null key
    is a key like any other; of rows equal in ``order`` one is the last).
    ``order`` begins with a time in ms.

    One window ranks the rows of a (key, time bucket).  A second one compares
    the buckets' last rows of a key, one per bucket; all other rows stay in
    their small partitions there."""
    bucket = F.coalesce(F.floor(F.col(order[0]) / bucket_ms), F.lit(-(2 ** 62)))    # nulls first, as in the order
    within = Window.partitionBy(key, "_bucket").orderBy(*[F.col(c) for c in order])
    ends = df.withColumn("_bucket", bucket).withColumn("_end", F.lead(F.lit(1)).over(within).isNull())
    ends = ends.withColumn("_part", F.when(~F.col("_end"), F.col("_bucket")))
    across = Window.partitionBy(key, "_part").orderBy("_bucket")
    return ends.withColumn(flag, F.col("_end") & F.lead(F.lit(1)).over(across).isNull()) \
        .drop("_bucket", "_end", "_part")


def deciding_order(order: Sequence[str], outputs: Sequence[str]) -> list[str]:
    """The part of ``order`` that can change ``outputs``: rows that agree in a
    beginning of it which holds every output column look the same there, so the
    columns after it need not be read or moved."""
    if not set(outputs) <= set(order):
        return list(order)
    return list(order[:max(list(order).index(c) for c in outputs) + 1])


def retract_duplicates(df: DataFrame, key: str, amounts: Sequence[str],
                       order: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """SEQ-7 retraction stream.

    Every row is emitted once with ``sign`` = 1; every row that is followed by
    another row of the same ``key`` (in ``order``, which begins with a time in
    ms; exact repeats included) is emitted again with its amounts negated and
    ``sign`` = -1, keeping its own event time.  Summing any amount over the
    output therefore gives the latest row per key.

    ``keep`` names the columns of the output beside ``key`` (all when omitted).
    """
    if keep is not None:
        order = deciding_order(order, keep)
        df = df.select(key, *dict.fromkeys([*keep, *order]))
    signed = with_latest(df, key, order).withColumn(
        "sign", F.explode(F.when(F.col("_last"), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(-1)))))
    return signed.select(*[
        (F.col("sign") * F.col(c).try_cast("decimal(20,4)")).cast("decimal(20,4)").alias(c)
        if c in amounts else F.col(c) for c in (df.columns if keep is None else [key, *keep])], "sign")


def session_start(last_page_id) -> Column:
    """SEQ-2: a page view starts a session when it has no previous page."""
    return F.when(empty_or_null(last_page_id), 1).otherwise(0)
