"""User age-band labelling (PRJ-18 … PRJ-21, JN-11 … JN-14, JN-18 … JN-21,
AGG-8 … AGG-10, SCO-*, STR-9/10).

Batch design: every per-user step is an aggregate (partial + final) or an
interval join bucketed by time, so a user holding a large share of the log is
spread over tasks.  The running profile (AGG-9) is computed per one-minute
window — the reference keeps only the last profile of each minute (AGG-8) — so
its ordered step sees one row per user and active minute, never the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.functions.dates import age_years, decade, epoch_day_to_date, zodiac_sign
from tillstream.operators.cdc import table_changes
from tillstream.operators.joins import interval_join, lookup
from tillstream.operators.scoring import BANDS, pick_band, price_bucket, weight_score, weight_table

A = "after"


def _a(k: str) -> Column:
    return F.col(A)[k]


# ------------------------------------------------------------------ users
def user_profile(changes: DataFrame, today) -> DataFrame:
    """PRJ-19: user rows with gender default ``home``, ISO birthday, decade, age
    at ``today`` and zodiac sign."""
    u = table_changes(changes, "user_info").where(F.col(A).isNotNull())
    bd = epoch_day_to_date(_a("birthday"))
    t = F.lit(today).cast("date") if isinstance(today, str) else today
    return u.select(
        _a("id").alias("id"), _a("name").alias("uname"), _a("user_level").alias("user_level"),
        _a("login_name").alias("login_name"), _a("phone_num").alias("phone_num"),
        _a("email").alias("email"), F.coalesce(_a("gender"), F.lit("home")).alias("gender"),
        F.date_format(bd, "yyyy-MM-dd").alias("birthday"), decade(bd).alias("decade"),
        age_years(bd, t).alias("age"), zodiac_sign(bd).alias("zodiac_sign"), "ts_ms")


def user_supplement(changes: DataFrame) -> DataFrame:
    """PRJ-20: height / weight rows."""
    s = table_changes(changes, "user_info_sup_msg").where(F.col(A).isNotNull())
    return s.select(_a("uid").alias("uid"), _a("height").alias("height"),
                    _a("unit_height").alias("unit_height"), _a("weight").alias("weight"),
                    _a("unit_weight").alias("unit_weight"),
                    _a("create_ts").try_cast("bigint").alias("create_ts"), "ts_ms")


def enrich_user(users: DataFrame, sups: DataFrame, lower_ms: int = -1_800_000,
                upper_ms: int = 1_800_000) -> DataFrame:
    """JN-11: users ⨝ supplements on id = uid within ±30 min of event time."""
    j = interval_join(users, sups.select("uid", "height", "unit_height", "weight",
                                         "unit_weight", F.col("ts_ms").alias("sup_ts_ms")),
                      [("id", "uid")], "ts_ms", "sup_ts_ms", lower_ms, upper_ms)
    return j.drop("uid")


# ------------------------------------------------------------------- logs
def log_device_search(log: DataFrame) -> DataFrame:
    """PRJ-18 + PRJ-26: page logs → uid (``-1`` when absent), ts, device fields
    without sid/mid/is_new, first token of ``os``, and the keyword searched."""
    pg = log.where(F.col("page").isNotNull())
    return pg.select(
        F.coalesce(F.col("common.uid"), F.lit("-1")).alias("uid"), "ts",
        F.col("common.ar").alias("ar"), F.col("common.ba").alias("ba"),
        F.col("common.ch").alias("ch"), F.col("common.md").alias("md"),
        F.split(F.col("common.os"), " ").getItem(0).alias("os"), F.col("common.vc").alias("vc"),
        F.when(F.col("page.item_type") == "keyword", F.col("page.item")).alias("search_item"))


def dedup_rows(df: DataFrame) -> DataFrame:
    """STR-9: exact duplicate rows removed (the reference keys by user and the
    whole JSON text; the user is part of the row)."""
    return df.dropDuplicates()


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """STR-10: first row per key by ``order`` (exact; a Bloom filter's false
    positives are not reproduced)."""
    cols = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.min_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_f"))
            .select(*keys, "_f.*"))


def last_per_window(df: DataFrame, key: str, ts: str, size_ms: int,
                    order: list[str] | None = None) -> DataFrame:
    """AGG-8: the last row of every (key, tumbling window)."""
    order = order or [ts]
    cols = [c for c in df.columns if c != key]
    return (df.groupBy(key, F.floor(F.col(ts) / size_ms).alias("_w"))
            .agg(F.max_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_l"))
            .select(key, (F.col("_w") * size_ms).alias("window_start_ms"), "_l.*"))


SET_FIELDS = ["os", "ch", "md", "ba", "search_item"]


def running_profile(proj: DataFrame, size_ms: int = 60_000) -> DataFrame:
    """AGG-9 then AGG-8: per (uid, window) what scoring reads of the profile so
    far: the page count, the first element of the sorted os set and of the
    sorted ts set, and the latest search item.

    Rows are reduced to one per (uid, minute) by hash-partial aggregates first;
    only those, bounded by the calendar whatever a uid's share of the log, meet
    in the running window.  The elements of the sets are
    :func:`profile_values`."""
    found = F.col("search_item").isNotNull()
    per_win = proj.groupBy("uid", F.floor(F.col("ts") / size_ms).alias("_w")).agg(
        F.count("*").alias("_n"), F.min("ts").alias("_ts"), F.min("os").alias("_os"),
        F.max(F.when(found, F.struct("ts", "search_item"))).alias("_search"))
    w = Window.partitionBy("uid").orderBy("_w").rowsBetween(Window.unboundedPreceding, 0)
    return per_win.select(
        "uid", (F.col("_w") * size_ms).alias("window_start_ms"), F.sum("_n").over(w).alias("pv"),
        F.min("_os").over(w).alias("os"), F.min("_ts").over(w).cast("string").alias("ts"),
        F.last(F.col("_search.search_item"), ignorenulls=True).over(w).alias("last_search"))


def profile_values(proj: DataFrame, size_ms: int = 60_000) -> DataFrame:
    """AGG-9's sets as rows: (uid, field, value, first_window_ms).  A profile's
    set at some minute is the values whose first window is not later."""
    vals = proj.select("uid", "ts", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in SET_FIELDS])).alias("v"))
    return (vals.where(F.col("v.value").isNotNull()).groupBy("uid", "v.field", "v.value")
            .agg(F.min(F.floor(F.col("ts") / size_ms) * size_ms).alias("first_window_ms")))


def category_hierarchy(dims: dict[str, DataFrame]) -> DataFrame:
    """JN-18: category3 ⨝ category2 ⨝ category1 (inner)."""
    c3, c2, c1 = dims["category3"], dims["category2"], dims["category1"]
    j = (c3.join(c2.select(F.col("id").alias("c2_id"), F.col("name").alias("b2name"),
                           "category1_id"), c3["category2_id"] == F.col("c2_id"))
           .join(c1.select(F.col("id").alias("c1_id"), F.col("name").alias("b1name")),
                 F.col("category1_id") == F.col("c1_id")))
    return j.select("id", F.col("name").alias("b3name"), "b2name", "b1name")


def sku_brand_category(dims: dict[str, DataFrame], compare: DataFrame) -> DataFrame:
    """JN-19: sku ⟕ (category name, trademark name).  The category name is the
    search category of the sku's top-level category."""
    hier = category_hierarchy(dims)
    s = lookup(dims["sku"], hier, [("category3_id", "id")], {"b1name": "b1name"})
    s = lookup(s, compare, [("b1name", "category_name")], {"search_category": "bcname"})
    s = lookup(s, dims["trademark"], [("tm_id", "id")], {"tm_name": "btname"})
    return s.select("id", "bcname", "btname")


def flat_hierarchy(flat: DataFrame) -> DataFrame:
    """JN-18 from the flat sku dimension: (b3name, b1name), one scan."""
    return flat.select(F.col("category3_name").alias("b3name"), F.col("category1_name").alias("b1name")).distinct()


def flat_brand_category(flat: DataFrame, compare: DataFrame) -> DataFrame:
    """JN-19 from the flat sku dimension: one scan and one lookup."""
    s = lookup(flat, compare, [("category1_name", "category_name")], {"search_category": "bcname"})
    return s.select("id", "bcname", F.col("trademark_name").alias("btname"))


def score_logs(profile: DataFrame, hier: DataFrame, compare: DataFrame,
               spark: SparkSession) -> DataFrame:
    """SCO-1 + SCO-2 with JN-20: device scores from the first os, search scores
    from the latest search item's top category's search category."""
    p = profile.withColumn("judge_os", F.col("os"))
    p = lookup(p, hier, [("last_search", "b3name")], {"b1name": "b1_category"})
    p = lookup(p, compare, [("b1_category", "category_name")], {"search_category": "search_category"})
    p = weight_score(p, weight_table(spark, "device"), "judge_os", "device")
    return weight_score(p, weight_table(spark, "search"), "search_category", "search")


# ----------------------------------------------------------------- orders
def order_projection(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PRJ-21: (orders, order lines) without deletes."""
    o = table_changes(changes, "order_info").where(F.col("op") != "d").select(
        "op", _a("id").alias("order_id"), _a("create_time").alias("create_time"),
        _a("total_amount").alias("total_amount"), _a("user_id").alias("uid"), "ts_ms")
    d = table_changes(changes, "order_detail").where(F.col("op") != "d").select(
        "op", _a("order_id").alias("order_id"), "ts_ms", _a("sku_id").alias("sku_id"),
        _a("id").alias("detail_id"))
    return o, d


def order_skus(orders: DataFrame, details: DataFrame, lower_ms: int = -1_800_000,
               upper_ms: int = 1_800_000) -> DataFrame:
    """JN-12 then STR-10: orders ⨝ lines within ±30 min, one line per
    (order, event time) — the first by line time and id."""
    j = interval_join(orders, details.select(
        F.col("order_id").alias("d_order_id"), F.col("ts_ms").alias("d_ts_ms"), "sku_id",
        "detail_id"), [("order_id", "d_order_id")], "ts_ms", "d_ts_ms", lower_ms, upper_ms)
    return dedup_first(j.drop("d_order_id"), ["order_id", "ts_ms"], ["d_ts_ms", "detail_id", "sku_id"])


def score_orders(order_skus_df: DataFrame, mapping: DataFrame, spark: SparkSession,
                 compat: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """SCO-3 … SCO-6 with JN-21: price, brand and category scores and their
    per-band sum (and the columns ``keep``).  ``compat=True`` reproduces two reference slips (category
    scores always zero; five bands add the 25-29 price score)."""
    o = lookup(order_skus_df, mapping, [("sku_id", "id")], {"btname": "btname", "bcname": "bcname"})
    o = o.withColumn("price_bucket", price_bucket("total_amount"))
    o = weight_score(o, weight_table(spark, "price"), "price_bucket", "price")
    o = weight_score(o, weight_table(spark, "brand"), "btname", "brand", default_match="__default__")
    o = weight_score(o, weight_table(spark, "category", compat), "bcname", "category",
                     compat=compat)
    sums = []
    for b in BANDS:
        price_b = "25_29" if compat and b != "50" else b
        sums.append((F.col(f"brand_{b}") + F.col(f"category_{b}") + F.col(f"price_{price_b}"))
                    .cast("decimal(10,3)").alias(f"sum_{b}"))
    return o.select("order_id", "uid", "sku_id", "ts_ms", "btname", "bcname", "price_bucket", *sums, *keep)


def age_band(users: DataFrame, order_scores: DataFrame, log_scores: DataFrame) -> DataFrame:
    """SCO-7 + TOP-2: users ⨝ their scored orders within ±30 min (JN-13), ⨝
    their scored logs within ±12 h of that pair's time (JN-14); the scores are
    added per band and the label is the band with the largest total.  A user
    without such a pair has no row."""
    logs = log_scores.select(
        F.col("uid").alias("l_uid"), F.col("ts").try_cast("bigint").alias("log_ts"), "window_start_ms",
        *[f"{k}_{b}" for k in ("search", "device") for b in BANDS])
    j = interval_join(user_order_pairs(users, order_scores), logs, [("id", "l_uid")], "event_ts_ms",
                      "log_ts", -12 * 3_600_000, 12 * 3_600_000)
    return band_rows(j)


def band_rows(j: DataFrame) -> DataFrame:
    """SCO-7 + TOP-2 over user ⨝ order scores ⨝ log scores rows."""
    totals = [(F.col(f"sum_{b}") + F.col(f"search_{b}") + F.col(f"device_{b}"))
              .cast("decimal(10,3)").alias(f"total_{b}") for b in BANDS]
    out = j.select("id", "uname", "gender", "age", "zodiac_sign", "decade", "order_id", "event_ts_ms",
                   "window_start_ms", *totals)
    return out.withColumn("max_age", pick_band([F.col(f"total_{b}") for b in BANDS]))


def user_order_values(orders: DataFrame) -> DataFrame:
    """AGG-10's sets as rows: (uid, field, value) of the order ids and create
    times seen for a user."""
    return orders.select("uid", F.explode(F.array(
        F.struct(F.lit("order_id").alias("field"), F.col("order_id").alias("value")),
        F.struct(F.lit("create_time").alias("field"), F.col("create_time").alias("value")))).alias("v")) \
        .where(F.col("v.value").isNotNull()).select("uid", "v.field", "v.value").distinct()


def user_orders_profile(orders: DataFrame) -> DataFrame:
    """AGG-10 (batch form): per user the order count, the first and last
    create time and order id, the amount total and distinct orders.  The
    reference's comma-joined sets of ids and times grow without bound: their
    elements are rows of :func:`user_order_values`."""
    return orders.groupBy("uid").agg(
        F.count("*").alias("pv"), F.min("create_time").alias("first_create_time"),
        F.max("create_time").alias("last_create_time"),
        F.countDistinct("order_id").alias("n_orders"),
        F.sum(F.col("total_amount").try_cast("decimal(20,2)")).alias("total_amount_sum"),
        F.min("ts_ms").alias("first_ts_ms"), F.max("ts_ms").alias("last_ts_ms"))


def user_order_pairs(users: DataFrame, order_scores: DataFrame, lower_ms: int = -1_800_000,
                     upper_ms: int = 1_800_000) -> DataFrame:
    """JN-13: users ⨝ scored orders within ±30 min (time-bucketed); the joined
    row's event time is the later of the two, so a chained windowed or
    interval step sees one time column."""
    o = order_scores.select(F.col("uid").alias("o_uid"), F.col("ts_ms").alias("o_ts_ms"),
                            "order_id", *[f"sum_{b}" for b in BANDS])
    j = interval_join(users, o, [("id", "o_uid")], "ts_ms", "o_ts_ms", lower_ms, upper_ms)
    return j.withColumn("event_ts_ms", F.greatest("ts_ms", "o_ts_ms")).drop("o_uid")
