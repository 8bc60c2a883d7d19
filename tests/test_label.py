from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tillstream.operators import label, scoring


def test_running_profile_sets_and_last_search(spark):
    T = 1_704_067_200_000
    proj = spark.createDataFrame([
        ("u", T + 1000, "iOS", "oppo", "m1", "Apple", None),
        ("u", T + 2000, "Android", "oppo", "m1", "Apple", "small size 1"),
        ("u", T + 61_000, "iOS", "vivo", "m2", "Apple", None),
    ], "uid string, ts bigint, os string, ch string, md string, ba string, search_item string")
    got = label.running_profile(proj).orderBy("window_start_ms").collect()
    assert [(r.pv, r.os, r.ts, r.last_search) for r in got] == [
        (2, "Android", str(T + 1000), "small size 1"), (3, "Android", str(T + 1000), "small size 1")]
    values = rows(label.profile_values(proj).where("field in ('ch', 'os')"), "field", "value", "first_window_ms")
    w = T - T % 60_000
    assert values == [("ch", "oppo", w), ("ch", "vivo", w + 60_000), ("os", "Android", w), ("os", "iOS", w)]


def test_scores_defaults_and_compat(spark):
    skus = spark.createDataFrame([
        ("o1", "u1", "s1", 1, "500.00"), ("o2", "u1", "s2", 2, "5000.00")],
        "order_id string, uid string, sku_id string, ts_ms bigint, total_amount string")
    mapping = spark.createDataFrame([("s1", "时尚与潮流", "苹果"), ("s2", None, None)],
                                    "id string, bcname string, btname string")
    out = {r.order_id: r for r in label.score_orders(skus, mapping, spark).collect()}
    # s1: brand 苹果 .9*.2=.18, category 时尚与潮流 .9*.3=.27, price 0-1000 .8*.15=.12
    assert out["o1"].sum_18_24 == Decimal("0.570")
    # s2: null brand → default row (.4*.2=.08), null category → 0, price other .1*.15=.015
    assert out["o2"].sum_18_24 == Decimal("0.095")
    compat = {r.order_id: r for r in label.score_orders(skus, mapping, spark, compat=True).collect()}
    # compat: category always zero, and bands use the 25-29 price score
    assert compat["o1"].sum_18_24 == Decimal("0.180") + Decimal("0.090")


def test_weight_table_rounding(spark):
    t = {r.match: r for r in scoring.weight_table(spark, "device").collect()}
    assert t["iOS"].device_18_24 == Decimal("0.070") and t["Android"].device_50 == Decimal("0.030")


def _scored(spark, cols, recs):
    bands = ", ".join(f"{k}_{b} decimal(10,3)" for k in cols[1] for b in scoring.BANDS)
    n = len(cols[1]) * len(scoring.BANDS)
    return spark.createDataFrame([(*r, *([Decimal("0.1")] * n)) for r in recs], f"{cols[0]}, {bands}")


def test_age_band_needs_a_pair_in_time(spark):
    H = 3_600_000
    users = spark.createDataFrame(
        [(i, "n", "F", 30, "z", "1990", 100 * H) for i in ("1", "2", "3")],
        "id string, uname string, gender string, age int, zodiac_sign string, decade string, ts_ms bigint")
    orders = _scored(spark, ("uid string, ts_ms bigint, order_id string", ["sum"]),
                     [("1", 100 * H + 1_800_000, "a"), ("1", 100 * H + 1_800_001, "b"), ("2", 100 * H, "c")])
    logs = _scored(spark, ("uid string, ts string, window_start_ms bigint", ["search", "device"]),
                   [("1", str(112 * H + 1_800_000), 1), ("1", str(113 * H), 2), ("3", str(100 * H), 3)])
    got = rows(label.age_band(users, orders, logs), "id", "order_id", "window_start_ms", "total_50", "max_age")
    assert got == [("1", "a", 1, Decimal("0.300"), "18-24")]      # equal totals: the first band


def test_dedup_first_and_rows(spark):
    df = spark.createDataFrame([("o", 1, "b", 5), ("o", 1, "a", 3), ("o", 2, "c", 1)],
                               "order_id string, ts_ms bigint, sku_id string, d_ts bigint")
    got = rows(label.dedup_first(df, ["order_id", "ts_ms"], ["d_ts"]), "order_id", "ts_ms", "sku_id")
    assert got == [("o", 1, "a"), ("o", 2, "c")]
    assert label.dedup_rows(df.unionByName(df)).count() == 3


def test_user_order_pairs_bounds_and_event_time(spark):
    T = 1_704_067_200_000
    users = spark.createDataFrame([("u1", T)], "id string, ts_ms bigint")
    scores = spark.createDataFrame(
        [("u1", T + 1_800_000, "inside"), ("u1", T + 1_800_001, "outside"), ("u1", T - 60_000, "before")],
        "uid string, ts_ms bigint, order_id string").select(
        "*", *[F.lit(Decimal("0.100")).cast("decimal(10,3)").alias(f"sum_{b}") for b in scoring.BANDS])
    got = rows(label.user_order_pairs(users, scores), "order_id", "event_ts_ms")
    assert got == [("before", T), ("inside", T + 1_800_000)]
