"""Comment moderation as one streaming query (JN-15, PRJ-22 … PRJ-24, STR-10,
MOD-1, MOD-2): comments meet their order's records within ±1 min, one row per
(order, time) is kept, and each micro-batch is checked against the word table
as it is then and written by day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.dates import ms_to_compact_date
from tillstream.operators import moderation
from tillstream.sinks.writers import write_batch_append
from tillstream.streaming.jobs import _start, dedup_first_stream, timed_join_stream, with_event_time


def message_stream(comment_changes: DataFrame, order_changes: DataFrame, delay: str = "0 seconds",
                   within: str = "1 minute") -> DataFrame:
    """The rows to check (see ``operators.moderation.messages``), each once the
    watermark has passed its time: which of an (order, time)'s rows is first is
    decided then."""
    c = with_event_time(moderation.comment_images(comment_changes), "ts_ms", delay, "c_et", counted="comments")
    orders = moderation.order_rows(order_changes)
    o = with_event_time(orders.select(*[F.col(x).alias(f"info_{x}") for x in orders.columns]),
                        "info_tm_ms", delay, "o_et", counted="orders")
    j = timed_join_stream(c, o, [("order_id", "info_id")], "c_et", "o_et", f"-{within}", within)
    j = j.withColumn("ds", ms_to_compact_date(F.col("ts_ms")))
    return moderation.message_columns(
        dedup_first_stream(j, ["order_id", "ts_ms"], "c_et", moderation.FIRST_BY))


def moderation_job(comment_changes: DataFrame, order_changes: DataFrame, words: Callable[[], DataFrame],
                   base: str, checkpoint: str, delay: str = "0 seconds", fmt: str = "parquet",
                   trigger: dict | None = None):
    """MOD-1 then MOD-2 on a stream.  ``words()`` gives the word table and is
    called once per micro-batch (``sources.refresh.Refreshed`` limits how often
    it is read), so a word takes effect with the next micro-batch.  The rows go
    to one folder per day, ``ds``, below the batch's own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_append(moderation.checked(batch, words()), base, batch_id, fmt, partition_by=["ds"])

    return _start(message_stream(comment_changes, order_changes, delay), write, checkpoint, trigger)
