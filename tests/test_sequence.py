from pyspark.sql import functions as F

from tests.conftest import rows
from tillstream.operators import dws, sequence

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def test_daily_unique_same_day_next_day_backwards(spark):
    df = spark.createDataFrame([
        ("m1", T0 + 1000, 1), ("m1", T0 + 2000, 2),          # same day twice
        ("m1", T0 + DAY, 3),                                 # next day
        ("m2", T0 + DAY, 4), ("m2", T0 + 5, 5),              # second device, out of order
    ], "mid string, ts bigint, log_id bigint")
    got = rows(sequence.daily_firsts(df, "mid", "ts", "log_id", []), "mid", "ts")
    assert got == [("m1", T0 + 1000), ("m1", T0 + DAY), ("m2", T0 + 5), ("m2", T0 + DAY)]
    assert rows(sequence.daily_firsts(df, "mid", "ts", "log_id", ["log_id"]), "log_id") == [(1,), (3,), (4,), (5,)]


def test_returning_user_gaps(spark):
    # previous login at day 0 (any hour); gaps counted from that day's midnight
    df = spark.createDataFrame([
        ("a", T0 + 5 * 3_600_000, 1), ("a", T0 + 7 * DAY + 1, 2),     # 7 days → not back
        ("b", T0 + 5 * 3_600_000, 3), ("b", T0 + 8 * DAY, 4),         # exactly 8 → back
        ("c", T0 + 23 * 3_600_000, 5), ("c", T0 + 9 * DAY + 10, 6),   # 9 → back
        ("c", T0 + 9 * DAY + 20, 7),                                   # same day again: no row
    ], "uid string, ts bigint, log_id bigint")
    got = rows(sequence.returning_users(df, "uid", "ts", "log_id", 8), "uid", "ts", "uu_ct", "back_ct")
    assert got == [("a", T0 + 5 * 3_600_000, 1, 0), ("a", T0 + 7 * DAY + 1, 1, 0),
                   ("b", T0 + 5 * 3_600_000, 1, 0), ("b", T0 + 8 * DAY, 1, 1),
                   ("c", T0 + 23 * 3_600_000, 1, 0), ("c", T0 + 9 * DAY + 10, 1, 1)]


def _log(spark, recs):
    return spark.createDataFrame(
        [({"mid": m, "is_new": n}, ts, i) for m, n, ts, i in recs],
        "common struct<mid:string,is_new:string>, ts bigint, log_id bigint")


def test_repair_is_new_cases(spark):
    log = _log(spark, [
        ("a", "1", T0, 1), ("a", "1", T0 + 10, 2),          # first 1, same day: kept
        ("a", "1", T0 + DAY, 3),                            # next day: repaired to 0
        ("b", "0", T0, 4), ("b", "1", T0 + 5, 5),           # first 0, then 1 same day: repaired
        ("c", None, T0, 6), ("c", "1", T0 + 1, 7),          # null flag behaves as 0
    ])
    got = rows(sequence.repair_is_new(log).select("log_id", "common.is_new"))
    assert got == [(1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0"), (6, None), (7, "0")]


def test_retraction_once_twice_thrice(spark):
    df = spark.createDataFrame([
        ("x", "10.0", 1), ("y", "5.0", 1), ("y", "6.0", 2), ("z", "1.0", 1), ("z", None, 2),
        ("z", "3.0", 3)], "id string, amt string, ts bigint")
    out = sequence.retract_duplicates(df, "id", ["amt"], ["ts"])
    got = rows(out, "id", "ts", "sign", "amt")
    assert [g[:3] for g in got] == [("x", 1, 1), ("y", 1, -1), ("y", 1, 1), ("y", 2, 1),
                                    ("z", 1, -1), ("z", 1, 1), ("z", 2, -1), ("z", 2, 1), ("z", 3, 1)]
    sums = {r.id: r.s for r in out.groupBy("id").agg({"amt": "sum"}).withColumnRenamed(
        "sum(amt)", "s").collect()}
    assert float(sums["y"]) == 6.0 and float(sums["z"]) == 3.0 and float(sums["x"]) == 10.0


def test_retraction_of_exact_repeats_ties_and_null_ids(spark):
    df = spark.createDataFrame([
        ("a", "1.0", 1), ("a", "1.0", 1), ("a", "1.0", 1),      # exact repeats: two are taken back
        (None, "2.0", 1), (None, "3.0", 2), ("b", "bad", 1)], "id string, amt string, ts bigint")
    out = sequence.retract_duplicates(df, "id", ["amt"], ["ts", "amt"])
    sums = {r.id: (r.n, r.s) for r in out.groupBy("id").agg(
        F.count("*").alias("n"), F.sum("amt").alias("s")).collect()}
    assert (sums["a"][0], float(sums["a"][1])) == (5, 1.0)
    assert (sums[None][0], float(sums[None][1])) == (3, 3.0)
    assert sums["b"] == (1, None)


def _details(spark, recs):
    return spark.createDataFrame(
        [(i, o, sku, p, ts, amt, amt, amt, amt) for i, o, sku, p, ts, amt in recs],
        "id string, order_id string, sku_id string, province_id string, ts_ms bigint, "
        "split_original_amount string, split_activity_amount string, split_coupon_amount string, "
        "split_total_amount string")


def test_money_windows_keep_null_keys(spark):
    d = _details(spark, [("1", "o1", None, None, T0, "5"), ("2", "o2", "s", "p", T0, "7"),
                         ("2", "o2", "s", "p", T0 + 1, "8"), (None, "o3", "s", "p", T0, "1"),
                         ("4", "o4", "s", "p", T0, "not money")])
    order = ["ts_ms", "sku_id"]
    sku = {r.sku_id: float(r.order_amount) for r in dws.sku_order_window_batch(d, order).collect()}
    assert sku == {None: 5.0, "s": 9.0}
    prov = {r.province_id: (float(r.order_amount), r.order_count)
            for r in dws.province_order_window_batch(d, order).collect()}
    assert prov == {None: (5.0, 1), "p": (9.0, 3)}


def test_sku_window_null_discount_counts_zero(spark):
    df = spark.createDataFrame([("s1", T0 + 1, "10.0", None, "1.0", "9.0")],
                               "sku_id string, ts_ms bigint, split_original_amount string, "
                               "split_activity_amount string, split_coupon_amount string, "
                               "split_total_amount string")
    r = dws.sku_order_window(df).first()
    assert float(r.activity_reduce_amount) == 0.0 and float(r.order_amount) == 9.0


def test_window_edge_and_empty(spark):
    # an event exactly on a window edge belongs to the later window
    pages = spark.createDataFrame([
        ("search", "keyword", "5G phone", T0 + 999), ("search", "keyword", "5G phone", T0 + 1000),
        ("home", "sku_id", "3", T0 + 5000)],
        "last_page_id string, item_type string, item string, ts bigint")
    got = rows(dws.keyword_window(pages, "1 second"), "stt", "keyword", "keyword_count")
    assert got == [("2024-01-01 00:00:00", "5g", 1), ("2024-01-01 00:00:00", "phone", 1),
                   ("2024-01-01 00:00:01", "5g", 1), ("2024-01-01 00:00:01", "phone", 1)]


def _versions(spark):
    """A hot id and the null id hold a third of all rows each."""
    recs = []
    for k in range(3000):
        i = ["hot", None, f"d{k % 400}"][k % 3]
        recs.append((i, f"s{k % 7}", f"p{k % 5}", f"o{k % 11}", 1_704_067_200_000 + (k * 7919) % 3000 * 1000,
                     str(k % 50), None if k % 13 == 0 else "1.5", None, "bad" if k % 17 == 0 else str(k)))
    recs += recs[:60]                                    # exact repeats
    return spark.createDataFrame(recs, "id string, sku_id string, province_id string, order_id string, ts_ms bigint, "
                                       "split_original_amount string, split_activity_amount string, "
                                       "split_coupon_amount string, split_total_amount string")


ORDER = ["ts_ms", "sku_id", "split_total_amount", "split_original_amount", "order_id"]


def _last_rows(recs):
    key = lambda r: tuple((r[c] is not None, r[c]) for c in ORDER)
    last = {}
    for r in recs:
        if r.id not in last or key(r) >= key(last[r.id]):
            last[r.id] = r
    return last


def test_latest_flags_with_a_hot_and_a_null_id(spark):
    from collections import Counter
    df = _versions(spark)
    last = _last_rows(df.collect())
    flagged = sequence.with_latest(df, "id", ORDER).collect()
    got = [r for r in flagged if r._last]
    assert Counter(r.id for r in got) == Counter(last.keys())   # one each, the null id too
    for r in got:
        assert all(r[c] == last[r.id][c] for c in ORDER)
    assert len(flagged) == df.count()
    sums = {r.id: r.n for r in sequence.retract_duplicates(df, "id", ["split_original_amount"], ORDER)
            .groupBy("id").agg(F.sum("split_original_amount").alias("n")).collect()}
    assert {i: float(n) for i, n in sums.items()} == {i: float(r.split_original_amount) for i, r in last.items()}


def test_a_hot_id_is_spread_over_tasks(spark):
    """No partition of either ranking step holds more than a small share."""
    df = _versions(spark)
    plan = sequence.with_latest(df, "id", ORDER)
    sizes = [r.n for r in plan.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.count("*").alias("n")).collect()]
    assert max(sizes) < 0.4 * df.count()


def test_money_windows_with_a_hot_and_a_null_id(spark):
    from collections import defaultdict
    df = _versions(spark)
    recs = df.collect()
    last = _last_rows(recs).values()

    def number(x):
        try:
            return float(x)
        except (TypeError, ValueError):
            return 0.0

    want, orders = defaultdict(float), defaultdict(set)
    for r in recs:
        orders[(r.ts_ms // 1000, r.province_id)].add(r.order_id)
        want[(r.ts_ms // 1000, r.province_id)] += 0.0
    for r in last:
        want[(r.ts_ms // 1000, r.province_id)] += number(r.split_total_amount)
    got = dws.province_order_window_batch(df, ORDER, None, "1 second").withColumn(
        "s", F.unix_timestamp("stt")).collect()
    assert {(r.s, r.province_id): float(r.order_amount) for r in got} == dict(want)
    assert {(r.s, r.province_id): r.order_count for r in got} == {k: len(v) for k, v in orders.items()}
    skus = defaultdict(float)
    for r in recs:
        skus[(r.ts_ms // 10_000, r.sku_id)] += 0.0
    for r in last:
        skus[(r.ts_ms // 10_000, r.sku_id)] += number(r.split_activity_amount)
    got = dws.sku_order_window_batch(df, ORDER, None, "10 seconds").withColumn("s", F.unix_timestamp("stt")).collect()
    assert {(r.s // 10, r.sku_id): float(r.activity_reduce_amount) for r in got} == dict(skus)


def test_order_stops_where_it_decides_the_output():
    assert sequence.deciding_order(["ts_ms", "a", "b", "c"], ["b", "ts_ms"]) == ["ts_ms", "a", "b"]
    assert sequence.deciding_order(["ts_ms", "a", "b"], ["ts_ms", "x"]) == ["ts_ms", "a", "b"]


def test_retractions_of_kept_columns(spark):
    df = _versions(spark)
    keep = ["split_original_amount", "ts_ms", "sku_id", "split_total_amount"]
    full = sequence.retract_duplicates(df, "id", ["split_original_amount"], ORDER)
    got = sequence.retract_duplicates(df, "id", ["split_original_amount"], ORDER, keep)
    assert got.columns == ["id", *keep, "sign"]
    assert rows(got) == rows(full, *got.columns)


def test_windows_break_ties_by_columns_outside_the_order(spark):
    df = spark.createDataFrame([("d", "s", "p1", "o1", T0, "1", "1", "1", "5.0"), ("d", "s", "p2", "o1", T0, "1", "1", "1", "5"),
                                ("d", "s", "p2", "o2", T0, "1", "1", "1", "bad")],
                               "id string, sku_id string, province_id string, order_id string, ts_ms bigint, "
                               "split_original_amount string, split_activity_amount string, "
                               "split_coupon_amount string, split_total_amount string")
    got = rows(dws.province_order_window_batch(df, ["ts_ms", "sku_id"]), "province_id", "order_count", "order_amount")
    assert [(p, n, float(a)) for p, n, a in got] == [("p1", 1, 0.0), ("p2", 2, 0.0)]
    got = rows(dws.sku_order_window_batch(df, ["ts_ms", "sku_id"]), "stt", "edt", "order_amount")
    assert [(s, e, float(a)) for s, e, a in got] == [("2024-01-01 00:00:00", "2024-01-01 00:00:10", 5.0)]
