"""Windowed aggregate tables (AGG-1 … AGG-7) and their dimension lookups
(JN-16, JN-17, JN-22).

Batch and streaming share the aggregation: ``groupBy(window(et, size), …)``
with partial + final hash aggregation.  Global windows (no key) are therefore
pre-aggregated per input partition, not funnelled into one task.  The first-of-
day flags come from ``tillstream.operators.sequence`` in batch and from the
stateful processors in ``tillstream.streaming`` on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.dates import ms_to_date, window_bounds
from tillstream.functions.text import empty_or_null, tokens
from tillstream.operators.joins import lookup
from tillstream.operators.sequence import daily_firsts, deciding_order, returning_users, session_start


def _win(ts_ms: str, size: str):
    return F.window(F.timestamp_millis(F.col(ts_ms)), size)


def page_views(log: DataFrame) -> DataFrame:
    """Page logs only, flattened to the columns the traffic tables read."""
    return log.where(F.col("page").isNotNull()).select(
        F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"),
        F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"), F.col("common.is_new").alias("is_new"),
        F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.item").alias("item"), F.col("page.item_type").alias("item_type"),
        F.col("page.during_time").alias("during_time"), "ts", "log_id")


def traffic_window(log: DataFrame, size: str = "10 seconds") -> DataFrame:
    """AGG-1 with SEQ-1/SEQ-2: page views, sessions, daily unique devices and
    dwell time per (window, vc, ch, ar, is_new)."""
    dims = ["vc", "ch", "ar", "is_new"]
    # A visit's place in its device's day as one number: time, then log id.
    place = (F.col("ts").cast("decimal(38,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.col("log_id")) \
        .cast("decimal(38,0)")
    seen = page_views(log).select(_win("ts", size).alias("window"), *dims, "mid", ms_to_date("ts").alias("day"),
                                  session_start(F.col("last_page_id")).alias("sv"),
                                  F.col("during_time").alias("dur"), place.alias("place"))
    # One row per device, day, window and dimensions; only these, bounded by the
    # calendar for each device, are compared within the device's day.
    each = seen.groupBy("window", *dims, "mid", "day").agg(
        F.sum("sv").alias("sv"), F.count("*").alias("pv"), F.sum("dur").alias("dur"), F.min("place").alias("place"))
    first = F.min("place").over(Window.partitionBy("mid", "day"))
    flagged = each.withColumn("uv", F.when(F.col("place") == first, 1).otherwise(0))
    agg = flagged.groupBy("window", *dims).agg(
        F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"), F.sum("pv").alias("pv_ct"),
        F.coalesce(F.sum("dur"), F.lit(0)).alias("dur_sum"))
    return agg.select(*window_bounds(), *dims, "uv_ct", "sv_ct", "pv_ct", "dur_sum")


def home_detail_window(log: DataFrame, size: str = "10 seconds") -> DataFrame:
    """AGG-2 with SEQ-3: daily unique visitors of the home and detail pages."""
    pv = page_views(log).where(F.col("page_id").isin("home", "good_detail"))
    firsts = pv.groupBy("mid", "page_id", ms_to_date("ts").alias("day")).agg(F.min("ts").alias("ts"))
    agg = (firsts.groupBy(_win("ts", size).alias("window"))
           .agg(F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).alias("home_uv_ct"),
                F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0))
                 .alias("good_detail_uv_ct")))
    return agg.select(*window_bounds(), "home_uv_ct", "good_detail_uv_ct")


def cart_user_window(cart_adds: DataFrame, size: str = "10 seconds",
                     ts: str = "ts_ms", tiebreak: str = "id") -> DataFrame:
    """AGG-3 with SEQ-4: daily unique cart-adding users per window."""
    firsts = daily_firsts(cart_adds, "user_id", ts, tiebreak, [])
    agg = firsts.groupBy(_win(ts, size).alias("window")).agg(F.count("*").alias("cart_add_uu_ct"))
    return agg.select(*window_bounds(), "cart_add_uu_ct")


def login_filter(pages: DataFrame) -> DataFrame:
    """PRJ-17: a user id is present and the previous page is empty or ``login``."""
    return pages.where(~empty_or_null(F.col("uid")) &
                       (empty_or_null(F.col("last_page_id")) | (F.col("last_page_id") == "login")))


def login_window(pages: DataFrame, size: str = "1 second", min_days: int = 8) -> DataFrame:
    """AGG-4 with SEQ-5: unique and returning users per window."""
    firsts = returning_users(login_filter(pages), "uid", "ts", "log_id", min_days)
    agg = (firsts.groupBy(_win("ts", size).alias("window"))
           .agg(F.sum("back_ct").alias("back_ct"), F.sum("uu_ct").alias("uu_ct")))
    return agg.select(*window_bounds(), "back_ct", "uu_ct")


SKU_AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount",
               "split_total_amount"]


def sku_order_window(details: DataFrame, dims: dict[str, DataFrame] | None = None,
                     size: str = "10 seconds") -> DataFrame:
    """AGG-5 then JN-16: four amount sums per (window, sku), enriched with the
    sku → spu → trademark → category3 → 2 → 1 chain *after* aggregation (one
    lookup per window and sku instead of per order line).

    ``details`` is the retraction stream (``retract_duplicates``) of the order
    detail fact; null discounts count as zero.
    """
    agg = (details.groupBy(_win("ts_ms", size).alias("window"), "sku_id")
           .agg(*[F.sum(F.coalesce(F.col(a).cast("decimal(20,4)"), F.lit(0))).alias(o) for a, o in zip(
               SKU_AMOUNTS, ["original_amount", "activity_reduce_amount",
                             "coupon_reduce_amount", "order_amount"])]))
    out = agg.select(*window_bounds(), "sku_id", "original_amount", "activity_reduce_amount",
                     "coupon_reduce_amount", "order_amount")
    return _sku_dims(out, dims)


def province_order_window(details: DataFrame, provinces: DataFrame | None = None,
                          size: str = "1 second") -> DataFrame:
    """AGG-6 then JN-17: order amount and distinct order count per
    (window, province).  ``countDistinct`` is planned as a two-level aggregate,
    so a hot province is still pre-aggregated map-side."""
    agg = (details.groupBy(_win("ts_ms", size).alias("window"), "province_id")
           .agg(F.sum(F.coalesce(F.col("split_total_amount").cast("decimal(20,4)"), F.lit(0)))
                 .alias("order_amount"),
                F.countDistinct("order_id").alias("order_count")))
    out = agg.select(*window_bounds(), "province_id", "order_count", "order_amount")
    if provinces is not None:
        out = lookup(out, provinces, [("province_id", "id")], {"name": "province_name"})
    return out


def search_keywords(pages: DataFrame) -> DataFrame:
    """PRJ-16 + JN-22: search pages exploded into one row per keyword token."""
    s = pages.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword")
                    & F.col("item").isNotNull())
    return s.select("ts", F.explode(tokens(F.col("item"))).alias("keyword"))


def keyword_window(pages: DataFrame, size: str = "1 second") -> DataFrame:
    """AGG-7: keyword counts per window (the reference's table-function job)."""
    agg = (search_keywords(pages).groupBy(_win("ts", size).alias("window"), "keyword")
           .agg(F.count("*").alias("keyword_count")))
    return agg.select(*window_bounds(), "keyword", "keyword_count")


# ------------------------------------------------------- batch fast paths
SKU_OUT = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]


def _amount(col: Column):
    """A money column as a number; a bad or null amount counts as zero."""
    return F.coalesce(col.try_cast("decimal(20,4)"), F.lit(0)).cast("decimal(20,4)")


def _latest_by_window(details: DataFrame, order: list[str], by: str, also: list[str], amounts: list[str],
                      size: str) -> DataFrame:
    """(``_start`` of the window, ``by``, ``also``, ``_kind``, amounts): from one
    read and one shuffle of the rows, the latest row of every id (``_kind`` 1) and,
    with zero amounts, every (window, ``by``, ``also``) that occurs (``_kind`` 0).

    Both are one aggregate over a row per kind: an id, null or not, that holds a
    third of all rows is reduced to one row per task before anything moves.  A
    row carries each column once, as it is compared; the window of a latest row
    and its amounts are computed after the aggregate."""
    zero = F.lit(0).cast("decimal(20,4)")
    rows = details.withColumn("window", _win("ts_ms", size))
    order = deciding_order(order, ["ts_ms", by, *also, *amounts])
    at = {c: f"o{k}" for k, c in enumerate(order)}
    rest = [c for c in dict.fromkeys(["ts_ms", by, *also, *amounts]) if c not in at]
    at.update({c: f"r{k}" for k, c in enumerate(rest)})
    start = F.unix_millis(F.col("window")["start"])
    picked = F.struct(*[F.col(c).alias(at[c]) for c in order], *[
        (start if c == "ts_ms" else _amount(F.col(c)) if c in amounts else F.col(c)).alias(at[c]) for c in rest])
    place = {"_ms": start, by: F.col(by), **{c: F.col(c) for c in also}}
    kinds = rows.select(F.explode(F.array(
        F.struct(F.lit(0).alias("_kind"), F.lit(None).cast(rows.schema["id"].dataType).alias("_id"),
                 *[c.alias(n) for n, c in place.items()], F.lit(None).alias("row")),
        F.struct(F.lit(1).alias("_kind"), F.col("id").alias("_id"), *[F.lit(None).alias(n) for n in place],
                 picked.alias("row")))).alias("k")).select("k.*")
    one = kinds.groupBy("_kind", "_id", *place).agg(F.max("row").alias("row"))
    latest = F.col("_kind") == 1
    out = one.select(
        "_kind", F.when(latest, F.col("row")[at["ts_ms"]]).otherwise(F.col("_ms")).alias("_ms"),
        *[F.when(latest, F.col("row")[at[c]]).otherwise(F.col(c)).alias(c) for c in [by, *also]],
        *[F.when(latest, _amount(F.col("row")[at[a]])).otherwise(zero).alias(a) for a in amounts])
    return out.withColumn("window", _win("_ms", size)) \
        .select("_kind", F.col("window")["start"].alias("_start"), by, *also, *amounts)


def _with_bounds(out: DataFrame, size: str) -> DataFrame:
    """The window's text columns for its ``_start``, after all that moves rows."""
    return out.withColumn("window", F.window("_start", size)) \
        .select(*window_bounds(), *[c for c in out.columns if c != "_start"])


def sku_order_window_batch(details: DataFrame, order: list[str],
                           dims: dict[str, DataFrame] | DataFrame | None = None,
                           size: str = "10 seconds") -> DataFrame:
    """AGG-5 + SEQ-7 on a whole batch.

    Summing the retraction stream over a window gives the sum of the ids whose
    *latest* row falls in it; a window that only held superseded rows still
    appears, with zeros.  ``dims`` is the flat sku dimension (one lookup), or
    the dimension tables of the chain."""
    out = (_latest_by_window(details, order, "sku_id", [], SKU_AMOUNTS, size).groupBy("_start", "sku_id")
           .agg(*[F.sum(a).alias(o) for a, o in zip(SKU_AMOUNTS, SKU_OUT)]))
    if isinstance(dims, DataFrame):
        # One row per window and sku meets one per sku: both grow, so they are merged at any size.
        out = lookup(out.hint("merge"), dims, [("sku_id", "id")], [c for c in dims.columns if c != "id"])
    else:
        out = _sku_dims(out, dims)
    return _with_bounds(out, size)


def _sku_dims(out: DataFrame, dims: dict[str, DataFrame] | None) -> DataFrame:
    if not dims:
        return out
    out = lookup(out, dims["sku"], [("sku_id", "id")],
                 {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "trademark_id",
                  "category3_id": "category3_id"})
    out = lookup(out, dims["spu"], [("spu_id", "id")], {"spu_name": "spu_name"})
    out = lookup(out, dims["trademark"], [("trademark_id", "id")], {"tm_name": "trademark_name"})
    out = lookup(out, dims["category3"], [("category3_id", "id")],
                 {"name": "category3_name", "category2_id": "category2_id"})
    out = lookup(out, dims["category2"], [("category2_id", "id")],
                 {"name": "category2_name", "category1_id": "category1_id"})
    return lookup(out, dims["category1"], [("category1_id", "id")], {"name": "category1_name"})


def province_order_window_batch(details: DataFrame, order: list[str],
                                provinces: DataFrame | None = None,
                                size: str = "1 second") -> DataFrame:
    """AGG-6 + SEQ-7 on a whole batch: amounts from each id's latest row; the
    distinct order count over every row (the reference's order-id set also
    collects superseded and retracted rows)."""
    rows = _latest_by_window(details, order, "province_id", ["order_id"], ["split_total_amount"], size)
    # Every (window, province, order) is one row of kind 0 already.
    out = rows.groupBy("_start", "province_id").agg(
        F.count(F.when(F.col("_kind") == 0, F.col("order_id"))).alias("order_count"),
        F.sum("split_total_amount").alias("order_amount"))
    if provinces is not None:
        out = lookup(out, provinces, [("province_id", "id")], {"name": "province_name"})
    return _with_bounds(out, size)
