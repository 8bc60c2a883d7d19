"""Streaming pipelines (STR-1 … STR-13) and the replay helper used by the
batch-equals-stream tests.

Event time is ``et = timestamp_millis(ts)``; watermarks follow the reference
(monotonous → ``0 seconds``, bounded → ``3 seconds``).  Late rows behind the
watermark are dropped by Spark (STR-11; see ``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.dates import window_bounds
from tillstream.sinks.writers import (foreach_batch_writer, kept_once, query_id, to_json_value,
                                      upsert_table, write_batch_append)
from tillstream.functions.text import empty_or_null, tokens
from tillstream.streaming.processors import (DailyFirst, LogRepair, NewVisitorRepair, Retraction,
                                             ReturningUser)


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "0 seconds", col: str = "et",
                    counted: str | None = None) -> DataFrame:
    """STR-1 / STR-2: event time from epoch ms plus a watermark.  Rows without a
    time cannot be placed in any window (the reference assigns time 0): they
    leave the stream here, :func:`untimed` is the side output that keeps them.
    With ``counted`` the query's progress reports under that name how many rows
    came and how many had no time (see :func:`event_time_account`)."""
    d = df.withColumn(col, F.timestamp_millis(F.col(ts)))
    if counted:
        d = d.observe(counted, F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col(col).isNull()).alias("untimed"))
    return d.where(F.col(col).isNotNull()).withWatermark(col, delay)


def untimed(df: DataFrame, ts: str = "ts") -> DataFrame:
    """STR-2's side output: the rows :func:`with_event_time` cannot place."""
    return df.where(F.timestamp_millis(F.col(ts)).isNull())


def event_time_account(query) -> dict[str, int]:
    """STR-2 / STR-11: what a query's event-time steps did not use, over its
    recent progress (``spark.sql.streaming.numRecentProgressUpdates`` says how
    far back): ``rows`` and ``untimed`` of all counted steps, and ``late``, the
    rows that stateful operators dropped behind the watermark."""
    total = {"rows": 0, "untimed": 0, "late": 0}
    for p in query.recentProgress:
        for row in p.observedMetrics.values():
            seen = row.asDict()
            total["rows"] += seen.get("rows", 0)
            total["untimed"] += seen.get("untimed", 0)
        total["late"] += sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
    return total


PAGE_FIELDS = [("mid", "string"), ("uid", "string"), ("vc", "string"), ("ch", "string"),
               ("ar", "string"), ("is_new", "string"), ("page_id", "string"),
               ("last_page_id", "string"), ("item", "string"), ("item_type", "string"),
               ("during_time", "bigint"), ("ts", "bigint"), ("log_id", "bigint")]


def _schema(fields) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields))


def _mode(ttl_ms: int | None) -> str:
    """Time mode of a processor: state that expires needs the clock.  Spark then
    runs empty batches without end: an ``availableNow`` run of such a job needs
    ``spark.sql.streaming.noDataMicroBatches.enabled=false``."""
    return "ProcessingTime" if ttl_ms else "None"


def traffic_window_stream(pages: DataFrame, size: str = "10 seconds",
                          delay: str = "0 seconds", zone: str = "UTC",
                          ttl_ms: int | None = None) -> DataFrame:
    """AGG-1 on a stream: SEQ-1 by a keyed processor (one day per device in
    state, optional TTL), then a watermarked tumbling-window aggregate."""
    cols = ["vc", "ch", "ar", "is_new", "ts", "log_id", "last_page_id", "during_time"]
    out_schema = _schema([f for f in PAGE_FIELDS if f[0] in cols] + [("uv", "bigint")])
    # state TTL is measured in processing time, so it needs that time mode
    flagged = pages.groupBy("mid").transformWithStateInPandas(
        DailyFirst(cols, "ts", "log_id", "uv", zone, ttl_ms), out_schema, "Append",
        _mode(ttl_ms))
    ev = with_event_time(flagged, "ts", delay)
    agg = (ev.groupBy(F.window("et", size).alias("window"), "vc", "ch", "ar", "is_new")
           .agg(F.sum("uv").alias("uv_ct"),
                F.sum(F.when(empty_or_null(F.col("last_page_id")), 1).otherwise(0)).alias("sv_ct"),
                F.count("*").alias("pv_ct"), F.sum("during_time").alias("dur_sum")))
    return agg.select(*window_bounds(), "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct",
                      "dur_sum")


def keyword_window_stream(pages: DataFrame, size: str = "1 second",
                          delay: str = "3 seconds") -> DataFrame:
    """AGG-7 / STR-5 on a stream: search pages → keyword tokens → counts per window."""
    s = pages.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword")
                    & F.col("item").isNotNull())
    ev = with_event_time(s.select("ts", F.explode(tokens(F.col("item"))).alias("keyword")), "ts", delay)
    agg = ev.groupBy(F.window("et", size).alias("window"), "keyword").agg(
        F.count("*").alias("keyword_count"))
    return agg.select(*window_bounds(), "keyword", "keyword_count")


def login_firsts_stream(logins: DataFrame, min_days: int = 8, zone: str = "UTC") -> DataFrame:
    """SEQ-5 on a stream (no TTL: the last login day is kept per user)."""
    return logins.groupBy("uid").transformWithStateInPandas(
        ReturningUser("uid", "ts", "log_id", min_days, zone),
        "uid string, ts bigint, uu_ct bigint, back_ct bigint", "Append", "None")


def repair_stream(pages: DataFrame, cols: Sequence[str], zone: str = "UTC",
                  ttl_ms: int | None = None) -> DataFrame:
    """SEQ-6 on a stream."""
    schema = _schema([f for f in PAGE_FIELDS if f[0] in cols])
    return pages.groupBy("mid").transformWithStateInPandas(
        NewVisitorRepair(list(cols), "ts", "log_id", zone, ttl_ms), schema, "Append", _mode(ttl_ms))


def retraction_stream(details: DataFrame, key: str, cols: Sequence[str], amounts: Sequence[str],
                      order: Sequence[str], ttl_ms: int | None = None) -> DataFrame:
    """SEQ-7 on a stream: all columns are text except ``ts_ms``."""
    schema = T.StructType([T.StructField(c, T.LongType() if c == "ts_ms" else T.StringType())
                           for c in cols] + [T.StructField("sign", T.LongType())])
    return details.groupBy(key).transformWithStateInPandas(
        Retraction(list(cols), list(amounts), list(order), ttl_ms), schema, "Append", _mode(ttl_ms))


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str = "ts_ms",
                 delay: str = "10 seconds") -> DataFrame:
    """STR-9 / STR-10: exact de-duplication whose state expires ``delay`` after
    each key's first event time (replaces the Bloom filter)."""
    return with_event_time(df, ts, delay).dropDuplicatesWithinWatermark(list(keys)).drop("et")


def dedup_first_stream(df: DataFrame, keys: Sequence[str], et: str, order: Sequence[str]) -> DataFrame:
    """STR-10 with a choice: of the rows of one key and event time the first by
    ``order``, once the watermark passes that time (``et`` carries it)."""
    cols = [c for c in df.columns if c not in (*keys, et)]
    return (df.groupBy(et, *keys)
            .agg(F.min_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_f"))
            .select(et, *keys, "_f.*"))


def last_per_window_stream(ev: DataFrame, key: str, et: str, size: str, order: Sequence[str]) -> DataFrame:
    """AGG-8 on a stream: the last row by ``order`` of every (key, tumbling
    window), once the watermark passes the window.  ``et`` carries the
    watermark; the result has ``window_start_ms`` and ``et``, the window's own
    event time for the operators after it."""
    cols = [c for c in ev.columns if c not in (key, et)]
    last = ev.groupBy(F.window(et, size).alias("window"), key).agg(
        F.max_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_l"))
    return last.select(key, F.unix_millis("window.start").alias("window_start_ms"), "_l.*",
                       F.window_time("window").alias(et))


def timed_join_stream(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_et: str,
                      right_et: str, lower: str, upper: str, *more, how: str = "inner") -> DataFrame:
    """A stream-stream join of sides that already carry watermarks on their
    event times: ``right_et`` within [lower, upper] of ``left_et``, and the
    conditions ``more``.  ``left_et`` stays, for stateful operators after it."""
    cond = [left[a] == right[b] for a, b in on]
    cond += [right[right_et] >= left[left_et] + F.expr(f"INTERVAL {lower}"),
             right[right_et] <= left[left_et] + F.expr(f"INTERVAL {upper}"), *more]
    return left.join(right, cond, how).drop(right_et)


def interval_join_stream(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                         left_ts: str, right_ts: str, lower: str, upper: str,
                         delay: str = "0 seconds", how: str = "inner") -> DataFrame:
    """JN-11 … JN-15 on streams: native stream-stream join with an event-time
    range, so both sides' state is evicted as the watermarks advance."""
    lft = with_event_time(left, left_ts, delay, "_let")
    rgt = with_event_time(right, right_ts, delay, "_ret")
    cond = [lft[lc] == rgt[rc] for lc, rc in on]
    cond += [rgt["_ret"] >= lft["_let"] + F.expr(f"INTERVAL {lower}"),
             rgt["_ret"] <= lft["_let"] + F.expr(f"INTERVAL {upper}")]
    return lft.join(rgt, cond, how).drop("_let", "_ret")


# -------------------------------------------------------------- job wiring
def _start(df: DataFrame, fn, checkpoint: str, trigger: dict | None, output_mode: str = "append"):
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(foreach_batch_writer(fn)))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def repaired_logs(text: DataFrame, zone: str = "UTC", ttl_ms: int | None = None,
                  tiebreak: str | None = None) -> DataFrame:
    """SEQ-6 over whole logs on a stream of JSON text: (``raw``, ``is_new``)
    of every message, good or bad, where ``is_new`` is the repaired
    flag.  The message itself travels as text beside the few fields the repair
    reads.  A device's logs of one instant are ordered by ``tiebreak`` (a column
    of ``text``; default: the message).  Bad messages and logs without a device
    are spread over keys of their own."""
    from tillstream.operators.logs import parse_log_tagged
    tagged = parse_log_tagged(text)
    mid = F.col("common.mid")
    other = F.concat(F.lit("x:"), F.pmod(F.xxhash64("_raw"), F.lit(1024)).cast("string"))
    tie = F.col(tiebreak) if tiebreak else F.col("_raw")
    rows = tagged.select(
        F.when(F.col("_ok") & mid.isNotNull(), F.concat(F.lit(LogRepair.DEVICE), mid)).otherwise(other)
        .alias("device"), F.col("_raw").alias("raw"), "ts", F.col("common.is_new").alias("is_new"),
        tie.alias("tie"))
    return rows.groupBy("device").transformWithStateInPandas(
        LogRepair(["raw", "is_new"], "ts", "tie", zone, ttl_ms), "raw string, is_new string", "Append",
        _mode(ttl_ms))


def log_split_job(text: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                  repair: bool = True, zone: str = "UTC", ttl_ms: int | None = None,
                  tiebreak: str | None = None):
    """SEQ-6 then SPL-1 … SPL-3 as one streaming query: the new-visitor flag is
    repaired by a stateful step over whole logs, and each micro-batch is parsed
    once for the five outputs (err / start / page / display / action) and the
    bad messages.  ``repair=False`` leaves the flags as they are (stateless).
    ``trigger`` defaults to a 5 s checkpoint cadence (STR-13)."""
    from tillstream.operators.logs import parse_log_tagged, split_log
    from tillstream.schemas import LOG

    def write(batch: DataFrame, batch_id: int) -> None:
        def outputs(parsed: DataFrame) -> None:
            write_batch_append(parsed.where("not _ok").select(F.col("_raw").alias("value")),
                               f"{base}/bad", batch_id, "json")
            good = parsed.where("_ok")
            if repair:
                good = good.withColumn("common", F.col("common").withField("is_new", F.col("_is_new")))
            for name, part in split_log(good.select(*LOG.fieldNames())).items():
                write_batch_append(part, f"{base}/{name}", batch_id, "json")
        rows = batch
        if repair:
            rows = batch.select(F.col("raw").alias("value"), F.col("is_new").alias("_is_new"))
        kept_once(parse_log_tagged(rows), outputs)

    stream = repaired_logs(text, zone, ttl_ms, tiebreak) if repair else text
    return _start(stream, write, checkpoint, trigger)


def quarantine_job(df: DataFrame, ts: str, base: str, checkpoint: str, fmt: str = "json",
                   trigger: dict | None = None):
    """STR-2: the rows without an event time, kept per micro-batch beside the
    job that could not place them."""
    return append_job(untimed(df, ts), base, checkpoint, fmt, trigger)


def upsert_job(changes: DataFrame, base: str, keys: Sequence[str], order: Sequence[str],
               checkpoint: str, delete_col: str | None = None, trigger: dict | None = None):
    """SNK-4 / SNK-6 / SNK-7 on a stream: every micro-batch is merged into a
    keyed table (``upsert_table``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, base, batch, keys, order, delete_col)

    return _start(changes, write, checkpoint, trigger)


def _routed(changes: DataFrame, config, route, base: str, checkpoint: str, trigger: dict | None):
    """One folder per sink table and batch; the configuration is read anew by
    ``config()`` for every micro-batch, so a change of it takes effect at the
    next one."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = route(batch, config())
        target = f"{base}/query={query_id(batch)}/batch={batch_id}"
        rows.write.mode("overwrite").partitionBy("sink_table").json(target)

    return _start(changes, write, checkpoint, trigger)


def dim_route_job(changes: DataFrame, config, base: str, checkpoint: str, trigger: dict | None = None):
    """JN-8 on a stream with live configuration (SRC-13)."""
    from tillstream.operators.cdc import route_dims
    return _routed(changes, config, route_dims, base, checkpoint, trigger)


def fact_route_job(changes: DataFrame, config, base: str, checkpoint: str, trigger: dict | None = None):
    """JN-9 / SNK-2 on a stream with live configuration."""
    from tillstream.operators.cdc import route_facts
    return _routed(changes, config, route_facts, base, checkpoint, trigger)


def append_job(rows_: DataFrame, base: str, checkpoint: str, fmt: str = "parquet",
               trigger: dict | None = None):
    """SNK-5: windowed results (append mode: each window once, after the
    watermark passes) written per micro-batch, idempotently."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_append(batch, base, batch_id, fmt)

    return _start(rows_, write, checkpoint, trigger)


def json_topic_job(df: DataFrame, topic: str, checkpoint: str, bootstrap_servers: str | None = None,
                   drop: Sequence[str] = (), trigger: dict | None = None):
    """SNK-1 on a stream: rows as JSON messages, one per row, exactly once with
    the checkpoint: to a Kafka topic (the connector jar must be on the
    classpath), or without ``bootstrap_servers`` to text files in the folder
    ``topic``."""
    w = to_json_value(df, drop=drop).writeStream.option("checkpointLocation", checkpoint)
    if bootstrap_servers:
        w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
    else:
        w = w.format("text").option("path", topic)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def order_detail_stream(changes: DataFrame, retention: str = "10 seconds",
                        delay: str = "0 seconds") -> DataFrame:
    """JN-1 / JN-2 / STR-8 on a stream: order lines ⨝ orders, ⟕ activity links,
    ⟕ coupon links.  The reference keeps idle join state for 10 s; here every
    join carries an event-time range of ``retention`` on both sides, so Spark
    evicts state once the watermarks pass.  Left-outer rows without a link are
    emitted once the watermark closes their range (append mode)."""
    from tillstream.functions.dates import text_to_date
    from tillstream.operators.cdc import table_changes
    a = F.col("after")

    def part(table, cols, ts_name):
        t = table_changes(changes, table, ["c"])
        return with_event_time(t.select(*cols, F.col("source")["ts_ms"].try_cast("bigint").alias(ts_name)),
                               ts_name, delay, ts_name + "_et")

    od = part("order_detail", [a["id"].alias("id"), a["order_id"].alias("order_id"),
                               a["sku_id"].alias("sku_id"), a["sku_name"].alias("sku_name"),
                               a["create_time"].alias("create_time"), a["sku_num"].alias("sku_num"),
                               (a["sku_num"].try_cast("decimal(16,2)") * a["order_price"].try_cast("decimal(16,2)"))
                               .cast("string").alias("split_original_amount"),
                               a["split_total_amount"].alias("split_total_amount"),
                               a["split_activity_amount"].alias("split_activity_amount"),
                               a["split_coupon_amount"].alias("split_coupon_amount")], "ts_ms")
    oi = part("order_info", [a["id"].alias("oi_id"), a["user_id"].alias("user_id"),
                             a["province_id"].alias("province_id")], "oi_ts")
    act = part("order_detail_activity", [a["order_detail_id"].alias("act_id"),
                                         a["activity_id"].alias("activity_id"),
                                         a["activity_rule_id"].alias("activity_rule_id")], "act_ts")
    cou = part("order_detail_coupon", [a["order_detail_id"].alias("cou_id"),
                                       a["coupon_id"].alias("coupon_id")], "cou_ts")
    rng = F.expr(f"INTERVAL {retention}")

    def within(x, y):
        return (F.col(y) >= F.col(x) - rng) & (F.col(y) <= F.col(x) + rng)

    j = od.join(oi, (F.col("order_id") == F.col("oi_id")) & within("ts_ms_et", "oi_ts_et"), "inner")
    j = j.join(act, (F.col("id") == F.col("act_id")) & within("ts_ms_et", "act_ts_et"), "leftOuter")
    j = j.join(cou, (F.col("id") == F.col("cou_id")) & within("ts_ms_et", "cou_ts_et"), "leftOuter")
    return j.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", text_to_date(F.col("create_time")).alias("date_id"),
        "create_time", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount", "ts_ms")


def _joined(left: DataFrame, right: DataFrame, on: tuple[str, str], left_ts: str, right_ts: str,
            retention: str, delay: str) -> DataFrame:
    """Inner stream-stream join on one key within ``retention`` either way."""
    return interval_join_stream(left, right, [on], left_ts, right_ts, f"-{retention}", retention, delay)


def order_cancel_stream(changes: DataFrame, details: DataFrame, retention: str = "1 day",
                        delay: str = "0 seconds") -> DataFrame:
    """PRJ-6 + JN-3 on a stream: ``details`` is the order-detail fact stream;
    state is kept for ``retention`` around the cancellation."""
    from tillstream.operators import facts
    c, shape = facts.cancelled_orders(changes), facts.cancel_columns()
    return _joined(details, c, ("order_id", "oc_id"), "ts_ms", "oc_ts_ms", retention, delay).select(*shape)


def _payments(changes: DataFrame, details: DataFrame, retention: str, delay: str) -> DataFrame:
    from tillstream.operators import facts
    return _joined(facts.paid_orders(changes), details, ("pi_order_id", "order_id"), "pi_ts_ms", "ts_ms",
                   retention, delay)


def _refunds(changes: DataFrame, retention: str, delay: str) -> DataFrame:
    from tillstream.operators import facts
    return _joined(facts.refund_requests(changes), facts.refunding_orders(changes), ("order_id", "oi_id"),
                   "ts_ms", "oi_ts_ms", retention, delay)


def payment_stream(changes: DataFrame, details: DataFrame, dic: DataFrame, retention: str = "1 day",
                   delay: str = "0 seconds") -> DataFrame:
    """PRJ-7 + JN-4 + JN-6 on a stream; the dictionary is a static table (see
    :func:`payment_job` for one that changes)."""
    from tillstream.operators import facts
    return facts.payment_names(_payments(changes, details, retention, delay), dic)


def refund_stream(changes: DataFrame, dic: DataFrame, retention: str = "1 day",
                  delay: str = "0 seconds") -> DataFrame:
    """PRJ-8 + JN-5 + JN-6 on a stream; the dictionary is a static table."""
    from tillstream.operators import facts
    return facts.refund_names(_refunds(changes, retention, delay), dic)


def lookup_job(rows_: DataFrame, names, dic, base: str, checkpoint: str, fmt: str = "parquet",
               trigger: dict | None = None):
    """SRC-13 / JN-6 / JN-7 on a stream: ``names(batch, dic())`` looks every
    micro-batch up in the dictionary as it is then.  ``dic`` is called once per
    micro-batch; ``sources.refresh.Refreshed`` gives it an age (the reference
    keeps looked-up rows for an hour)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_append(names(batch, dic()), base, batch_id, fmt)

    return _start(rows_, write, checkpoint, trigger)


def payment_job(changes: DataFrame, details: DataFrame, dic, base: str, checkpoint: str,
                retention: str = "1 day", delay: str = "0 seconds", trigger: dict | None = None):
    """PRJ-7 + JN-4 + JN-6 with a dictionary that may change."""
    from tillstream.operators import facts
    return lookup_job(_payments(changes, details, retention, delay), facts.payment_names, dic, base,
                      checkpoint, trigger=trigger)


def refund_job(changes: DataFrame, dic, base: str, checkpoint: str, retention: str = "1 day",
               delay: str = "0 seconds", trigger: dict | None = None):
    """PRJ-8 + JN-5 + JN-6 with a dictionary that may change."""
    from tillstream.operators import facts
    return lookup_job(_refunds(changes, retention, delay), facts.refund_names, dic, base, checkpoint,
                      trigger=trigger)


def comment_job(changes: DataFrame, dic, base: str, checkpoint: str, trigger: dict | None = None):
    """PRJ-11 + JN-6 with a dictionary that may change."""
    from tillstream.operators import facts
    return lookup_job(facts.posted_comments(changes), facts.comment_names, dic, base, checkpoint,
                      trigger=trigger)


def window_agg_stream(df: DataFrame, keys: Sequence[str], aggs: Sequence, size: str,
                      time: str = "event", ts: str = "ts", delay: str = "0 seconds") -> DataFrame:
    """STR-3 / STR-4 / STR-6: a tumbling-window aggregate on event time (default,
    repeatable) or on processing time (``time='processing'``: the window is
    taken from ``current_timestamp()`` at the micro-batch, as the reference's
    processing-time windows; results depend on arrival speed)."""
    if time == "processing":
        d = df.withColumn("_pt", F.current_timestamp()).withWatermark("_pt", "0 seconds")
        col = "_pt"
    else:
        d, col = with_event_time(df, ts, delay), "et"
    agg = d.groupBy(F.window(col, size).alias("window"), *keys).agg(*aggs)
    return agg.select(*window_bounds(), *keys, *[c for c in agg.columns if c not in ("window", *keys)])


def home_detail_window_stream(pages: DataFrame, size: str = "10 seconds",
                              delay: str = "0 seconds", zone: str = "UTC",
                              ttl_ms: int | None = None) -> DataFrame:
    """AGG-2 + SEQ-3 on a stream: separate daily states per (device, page);
    only first visits are emitted, then summed per window."""
    p = pages.where(F.col("page_id").isin("home", "good_detail")) \
        .withColumn("mid_page", F.concat_ws("\u0001", "mid", "page_id"))
    firsts = p.groupBy("mid_page").transformWithStateInPandas(
        DailyFirst(["page_id", "ts", "log_id"], "ts", "log_id", "uv", zone, ttl_ms, only_flagged=True),
        "page_id string, ts bigint, log_id bigint, uv bigint", "Append",
        _mode(ttl_ms))
    agg = with_event_time(firsts, "ts", delay).groupBy(F.window("et", size).alias("window")).agg(
        F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).alias("home_uv_ct"),
        F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0)).alias("good_detail_uv_ct"))
    return agg.select(*window_bounds(), "home_uv_ct", "good_detail_uv_ct")


def cart_user_window_stream(cart_adds: DataFrame, size: str = "10 seconds",
                            delay: str = "0 seconds", zone: str = "UTC",
                            ttl_ms: int | None = None) -> DataFrame:
    """AGG-3 + SEQ-4 on a stream: daily first cart add per user, counted per window."""
    firsts = cart_adds.groupBy("user_id").transformWithStateInPandas(
        DailyFirst(["ts_ms", "id"], "ts_ms", "id", "uv", zone, ttl_ms, only_flagged=True),
        "ts_ms bigint, id string, uv bigint", "Append", _mode(ttl_ms))
    agg = with_event_time(firsts, "ts_ms", delay).groupBy(F.window("et", size).alias("window")) \
        .agg(F.count("*").alias("cart_add_uu_ct"))
    return agg.select(*window_bounds(), "cart_add_uu_ct")


def login_window_stream(logins: DataFrame, size: str = "1 second", delay: str = "0 seconds",
                        min_days: int = 8, zone: str = "UTC") -> DataFrame:
    """AGG-4 + SEQ-5 on a stream: unique and returning users per window."""
    firsts = login_firsts_stream(logins, min_days, zone)
    agg = with_event_time(firsts, "ts", delay).groupBy(F.window("et", size).alias("window")).agg(
        F.sum("back_ct").alias("back_ct"), F.sum("uu_ct").alias("uu_ct"))
    return agg.select(*window_bounds(), "back_ct", "uu_ct")


def sku_order_window_stream(details: DataFrame, order: Sequence[str], size: str = "10 seconds",
                            delay: str = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """AGG-5 + SEQ-7 on a stream: the retraction processor re-emits a repeated
    id's previous row negated (at its own time), then the window sums the
    stream.  Window sums equal the batch form's latest-row sums."""
    from tillstream.operators.dws import SKU_AMOUNTS
    cols = ["id", "sku_id", "ts_ms", *SKU_AMOUNTS, *[c for c in order if c not in
                                                     ("id", "sku_id", "ts_ms", *SKU_AMOUNTS)]]
    r = retraction_stream(details.select(*[F.col(c).cast("bigint" if c == "ts_ms" else "string")
                                           for c in cols]), "id", cols, SKU_AMOUNTS, order, ttl_ms)
    names = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]
    agg = with_event_time(r, "ts_ms", delay).groupBy(F.window("et", size).alias("window"), "sku_id").agg(
        *[F.sum(F.coalesce(F.col(a).try_cast("decimal(20,4)"), F.lit(0))).alias(o)
          for a, o in zip(SKU_AMOUNTS, names)])
    return agg.select(*window_bounds(), "sku_id", *names)


def province_order_window_stream(details: DataFrame, order: Sequence[str], size: str = "1 second",
                                 delay: str = "0 seconds", ttl_ms: int | None = None) -> DataFrame:
    """AGG-6 + SEQ-7 on a stream: retraction on the amount, then per window and
    province the amount sum and the exact number of distinct orders.  Two
    chained aggregates: the first keeps one state row per (window, province,
    order), the second counts them once the watermark has closed the window, so
    no state value grows with the orders of a hot province."""
    cols = ["id", "order_id", "province_id", "ts_ms", "split_total_amount",
            *[c for c in order if c not in ("id", "order_id", "province_id", "ts_ms",
                                            "split_total_amount")]]
    r = retraction_stream(details.select(*[F.col(c).cast("bigint" if c == "ts_ms" else "string")
                                           for c in cols]), "id", cols, ["split_total_amount"], order,
                          ttl_ms)
    each = with_event_time(r, "ts_ms", delay).groupBy(
        F.window("et", size).alias("window"), "province_id", "order_id").agg(
        F.sum(F.coalesce(F.col("split_total_amount").try_cast("decimal(20,4)"), F.lit(0))).alias("amount"))
    agg = each.groupBy(F.window(F.window_time("window"), size).alias("window"), "province_id").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))
    return agg.select(*window_bounds(), "province_id", "order_count", "order_amount")
