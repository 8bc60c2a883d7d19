"""The user age-band chain as one streaming query (AGG-9, AGG-8, SCO-*, STR-9,
STR-10, JN-12 … JN-14, JN-18 … JN-21).

Three inputs with a watermark each: page logs, order changes and users.  Every
stateful step keeps or hands on an event time, so the next one can close its
windows and drop its state:

* logs: exact duplicates go, a keyed processor keeps the running profile, the
  last profile of a minute is scored;
* orders: joined with their lines within ±30 min, one line per (order, time),
  scored;
* users meet their orders within ±30 min, and that pair the scored logs.

The batch form is ``operators.label``; the lookups and scores are its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators import label
from tillstream.operators.scoring import BANDS
from tillstream.streaming.jobs import (dedup_first_stream, last_per_window_stream, timed_join_stream,
                                       with_event_time)
from tillstream.streaming.processors import PROFILE_ROW, RunningProfile

HALF_DAY_MS = 12 * 3_600_000


def profile_stream(proj: DataFrame, delay: str = "0 seconds", size: str = "1 minute") -> DataFrame:
    """STR-9, AGG-9, AGG-8: the last profile of every (user, minute), with the
    columns of ``label.running_profile`` and the event time ``et``."""
    once = with_event_time(proj, "ts", delay, counted="logs").dropDuplicatesWithinWatermark(proj.columns)
    running = once.select("uid", "ts", "os", "search_item", "et").groupBy("uid").transformWithStateInPandas(
        RunningProfile(), PROFILE_ROW, "Append", "EventTime", eventTimeColumnName="et")
    last = last_per_window_stream(running, "uid", "et", size, ["event_ts", "pv"])
    return last.select("uid", "window_start_ms", "pv", "os", F.col("ts").cast("string").alias("ts"),
                       "last_search", "et")


def order_scores_stream(changes: DataFrame, mapping: DataFrame, spark: SparkSession,
                        delay: str = "0 seconds", within: str = "30 minutes") -> DataFrame:
    """PRJ-21, JN-12, STR-10, SCO-3 … SCO-6 with the event time ``o_et``."""
    orders, lines = label.order_projection(changes)
    o = with_event_time(orders, "ts_ms", delay, "o_et", counted="orders")
    d = with_event_time(lines.select(
        F.col("order_id").alias("d_order_id"), F.col("ts_ms").alias("d_ts_ms"), "sku_id", "detail_id"),
        "d_ts_ms", delay, "d_et", counted="order_lines")
    j = timed_join_stream(o, d, [("order_id", "d_order_id")], "o_et", "d_et", f"-{within}", within)
    first = dedup_first_stream(j.drop("d_order_id"), ["order_id"], "o_et", ["d_ts_ms", "detail_id", "sku_id"])
    return label.score_orders(first, mapping, spark, keep=["o_et"])


def user_order_pairs_stream(users: DataFrame, order_scores: DataFrame, delay: str = "0 seconds",
                            within: str = "30 minutes") -> DataFrame:
    """JN-13: the pair's time ``event_ts_ms`` is the later of the two; the
    user's event time ``u_et``, at most ``within`` away, carries the watermark."""
    u = with_event_time(users, "ts_ms", delay, "u_et", counted="users")
    o = order_scores.select(F.col("uid").alias("o_uid"), F.col("ts_ms").alias("o_ts_ms"), "order_id",
                            *[f"sum_{b}" for b in BANDS], "o_et")
    j = timed_join_stream(u, o, [("id", "o_uid")], "u_et", "o_et", f"-{within}", within)
    return j.withColumn("event_ts_ms", F.greatest("ts_ms", "o_ts_ms")).drop("o_uid")


def age_band_stream(users: DataFrame, order_changes: DataFrame, log_projection: DataFrame,
                    mapping: DataFrame, hier: DataFrame, compare: DataFrame, spark: SparkSession,
                    delay: str = "0 seconds", retention: str = "1 day") -> DataFrame:
    """SCO-7 + TOP-2 on streams (see ``label.age_band``).

    A scored log is compared by its user's first log time, which no watermark
    bounds from above: a pair waits ``retention`` for the logs after it.  Users,
    categories and weights are static tables."""
    pairs = user_order_pairs_stream(users, order_scores_stream(order_changes, mapping, spark, delay), delay)
    scored = label.score_logs(profile_stream(log_projection, delay), hier, compare, spark)
    logs = scored.select(
        F.col("uid").alias("l_uid"), F.col("ts").try_cast("bigint").alias("log_ts"), "window_start_ms",
        *[f"{k}_{b}" for k in ("search", "device") for b in BANDS], F.col("et").alias("l_et"))
    near = F.abs(logs["log_ts"] - pairs["event_ts_ms"]) <= HALF_DAY_MS
    j = timed_join_stream(pairs, logs, [("id", "l_uid")], "u_et", "l_et", "-12 hours", retention, near)
    return label.band_rows(j)
