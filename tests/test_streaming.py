"""Batch = stream: the same rows replayed from files through the streaming
form give the batch form's result.  A sentinel row far in the future closes
every window; its own output is filtered out."""

import itertools
import json
import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tillstream.operators import dws, label, sequence
from tillstream.sources import driver as drv
from tillstream.streaming import jobs

SF = "/root/testdata/sf0.001"
FAR = 4_102_444_800_000  # 2100-01-01


def run_to_memory(stream, name, checkpoint, expiring=False):
    """Run a stream over everything available into a memory table.  With state
    that expires by the clock Spark would go on with empty batches for ever."""
    stream.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(not expiring).lower())
    q = (stream.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return stream.sparkSession.table(name)


WRITTEN = itertools.count(1_700_000_000)


def _write(path, name, records):
    """One file; files are a second apart, as a stream takes them by age."""
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
    at = next(WRITTEN)
    os.utime(os.path.join(path, name), (at, at))


def _replay(spark, df, path, sentinels, order):
    recs = [json.loads(s) for s in df.orderBy(*order).toJSON().collect()]
    _write(path, "part-0.json", recs)
    for i, s in enumerate(sentinels):
        _write(path, f"part-{i + 1}.json", [s])
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(path)


def _pages(spark):
    return dws.page_views(drv.events_log(drv.table(spark, SF, "events")))


def _sentinel_page(ts, log_id):
    return {"mid": "zz", "uid": "zz", "vc": "v", "ch": "c", "ar": "0", "is_new": "0",
            "page_id": "home", "last_page_id": "search", "item": "sentinel", "item_type": "keyword",
            "during_time": 0, "ts": ts, "log_id": log_id}


def test_keyword_window_stream_equals_batch(spark, tmp):
    pages = _pages(spark)
    stream = _replay(spark, pages, os.path.join(tmp, "in"),
                     [_sentinel_page(FAR, -1), _sentinel_page(FAR + 86_400_000, -2)], ["ts", "log_id"])
    out = run_to_memory(jobs.keyword_window_stream(stream, "1 second", "3 seconds"),
                             "kw_stream", os.path.join(tmp, "ckpt"))
    got = rows(out.where(F.col("keyword") != "sentinel"))
    assert got == rows(dws.keyword_window(pages, "1 second")) and len(got) > 0


def test_traffic_window_stream_equals_batch(spark, tmp):
    pages = _pages(spark)
    stream = _replay(spark, pages, os.path.join(tmp, "in"),
                     [_sentinel_page(FAR, -1), _sentinel_page(FAR + 86_400_000, -2)], ["ts", "log_id"])
    out = run_to_memory(jobs.traffic_window_stream(stream, "10 seconds", "0 seconds"),
                             "traffic_stream", os.path.join(tmp, "ckpt"))
    got = rows(out.where(F.col("stt") < "2099"))
    expected = rows(dws.traffic_window(drv.events_log(drv.table(spark, SF, "events")), "10 seconds"))
    assert got == expected and len(got) > 0


def test_login_stream_equals_batch(spark, tmp):
    pages = _pages(spark)
    logins = dws.login_filter(pages).select("uid", "ts", "log_id")
    stream = _replay(spark, logins, os.path.join(tmp, "in"), [], ["ts", "log_id"])
    out = run_to_memory(jobs.login_firsts_stream(stream), "login_stream", os.path.join(tmp, "ckpt"))
    expected = sequence.returning_users(logins, "uid", "ts", "log_id", 8).select(
        "uid", "ts", "uu_ct", "back_ct")
    assert rows(out) == rows(expected)


def test_interval_join_stream_equals_batch(spark, tmp):
    users = label.user_profile(drv.user_changes(drv.table(spark, SF, "customer")), "2025-06-15") \
        .select("id", "ts_ms", "uname")
    sups = label.user_supplement(drv.user_sup_changes(drv.table(spark, SF, "customer"))) \
        .select("uid", F.col("ts_ms").alias("sup_ts_ms"), "height")
    ls = _replay(spark, users, os.path.join(tmp, "u"), [], ["ts_ms"])
    rs = _replay(spark, sups, os.path.join(tmp, "s"), [], ["sup_ts_ms"])
    j = jobs.interval_join_stream(ls, rs, [("id", "uid")], "ts_ms", "sup_ts_ms",
                                  "-30 minutes", "30 minutes", "1 hour")
    out = run_to_memory(j.select("id", "sup_ts_ms", "height"), "ij_stream", os.path.join(tmp, "ckpt"))
    batch = label.enrich_user(label.user_profile(drv.user_changes(drv.table(spark, SF, "customer")),
                                                 "2025-06-15"),
                              label.user_supplement(drv.user_sup_changes(drv.table(spark, SF, "customer"))))
    assert rows(out) == rows(batch.select("id", "sup_ts_ms", "height")) and out.count() > 0


def test_dedup_within_watermark(spark, tmp):
    recs = [{"order_id": "1", "ts_ms": 1000, "v": "a"}, {"order_id": "1", "ts_ms": 1000, "v": "b"},
            {"order_id": "1", "ts_ms": 2000, "v": "c"}, {"order_id": "2", "ts_ms": 1000, "v": "d"}]
    _write(os.path.join(tmp, "in"), "p0.json", recs)
    stream = spark.readStream.schema("order_id string, ts_ms bigint, v string").json(os.path.join(tmp, "in"))
    out = run_to_memory(jobs.dedup_stream(stream, ["order_id", "ts_ms"], "ts_ms", "10 seconds"),
                             "dedup_stream", os.path.join(tmp, "ckpt"))
    assert rows(out, "order_id", "ts_ms") == [("1", 1000), ("1", 2000), ("2", 1000)]


def test_log_split_job_writes_all_outputs(spark, tmp):
    from tests.test_io import LOGS
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(LOGS) + "\n")
    text = spark.readStream.format("text").load(src)
    q = jobs.log_split_job(text, os.path.join(tmp, "out"), os.path.join(tmp, "ckpt"),
                           trigger={"availableNow": True})
    q.awaitTermination()
    counts = {n: spark.read.json(os.path.join(tmp, "out", n)).count()  # one query folder, one batch
              for n in ["err", "start", "page", "display", "action"]}
    assert counts == {"err": 1, "start": 1, "page": 2, "display": 2, "action": 1}
    assert spark.read.json(os.path.join(tmp, "out", "bad")).count() == 1


def test_upsert_job_equals_batch_upsert(spark, tmp):
    from tillstream.operators import cdc
    from tillstream.sinks.writers import current_table
    recs = [{"id": "1", "v": "a", "ts": 1, "d": False}, {"id": "2", "v": "b", "ts": 1, "d": False}]
    recs2 = [{"id": "1", "v": "c", "ts": 2, "d": False}, {"id": "2", "v": "b", "ts": 3, "d": True}]
    src = os.path.join(tmp, "in")
    _write(src, "p0.json", recs)
    _write(src, "p1.json", recs2)
    stream = spark.readStream.schema("id string, v string, ts bigint, d boolean") \
        .option("maxFilesPerTrigger", 1).json(src)
    q = jobs.upsert_job(stream, os.path.join(tmp, "table"), ["id"], ["ts"],
                        os.path.join(tmp, "ckpt"), delete_col="d", trigger={"availableNow": True})
    q.awaitTermination()
    batch = cdc.upsert(None, spark.createDataFrame(recs + recs2, "id string, v string, ts bigint, d boolean"),
                       ["id"], ["ts"], delete_col="d")
    assert rows(current_table(spark, os.path.join(tmp, "table")), "id", "v") == rows(batch, "id", "v") \
        == [("1", "c")]


def test_order_detail_stream_equals_batch(spark, tmp):
    from tillstream.operators import facts
    o = drv.order_changes(drv.table(spark, SF, "orders")).where(F.col("op") == "c")
    d = drv.detail_changes(drv.table(spark, SF, "lineitem"))
    ch = o.unionByName(d)
    far = FAR
    # every branch has its own watermark and the global one is their minimum,
    # so each table gets far-future rows (two rounds: one to move, one to close)
    sentinels = []
    for t_ms in (far, far + 86_400_000):
        for table in ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"]:
            sentinels.append({"before": None, "after": {"id": "zz", "order_id": "zz",
                                                        "order_detail_id": "zz"},
                              "source": {"table": table, "ts_ms": str(t_ms)}, "op": "c", "ts_ms": t_ms})
    stream = _replay(spark, ch, os.path.join(tmp, "in"), sentinels, ["ts_ms"])
    out = run_to_memory(jobs.order_detail_stream(stream, "10 seconds", "0 seconds"),
                             "od_stream", os.path.join(tmp, "ckpt"))
    got = rows(out.where(F.col("id") != "zz"))
    expected = rows(facts.order_detail(ch))
    assert got == expected and len(got) > 0


def test_window_agg_stream_event_and_processing_time(spark, tmp):
    recs = [{"k": "a", "ts": 1000}, {"k": "a", "ts": 2000}, {"k": "b", "ts": 12000}]
    _write(os.path.join(tmp, "in"), "p0.json", recs)
    _write(os.path.join(tmp, "in"), "p1.json", [{"k": "z", "ts": FAR}])
    _write(os.path.join(tmp, "in"), "p2.json", [{"k": "z", "ts": FAR + 86_400_000}])
    src = spark.readStream.schema("k string, ts bigint").option("maxFilesPerTrigger", 1) \
        .json(os.path.join(tmp, "in"))
    ev = run_to_memory(jobs.window_agg_stream(src, ["k"], [F.count("*").alias("n")], "10 seconds"),
                            "win_ev", os.path.join(tmp, "c1"))
    assert rows(ev.where(F.col("k") != "z"), "stt", "k", "n") == [
        ("1970-01-01 00:00:00", "a", 2), ("1970-01-01 00:00:10", "b", 1)]
    src2 = spark.readStream.schema("k string, ts bigint").json(os.path.join(tmp, "in"))
    pt = jobs.window_agg_stream(src2, ["k"], [F.count("*").alias("n")], "1 hour", time="processing")
    assert pt.isStreaming and "stt" in pt.columns


def test_home_detail_and_login_windows_stream_equal_batch(spark, tmp):
    pages = _pages(spark)
    sent = [_sentinel_page(FAR, -1), _sentinel_page(FAR + 86_400_000, -2)]
    stream = _replay(spark, pages, os.path.join(tmp, "in"), sent, ["ts", "log_id"])
    out = run_to_memory(jobs.home_detail_window_stream(stream), "hd_stream", os.path.join(tmp, "c1"))
    expected = dws.home_detail_window(drv.events_log(drv.table(spark, SF, "events")), "10 seconds")
    assert rows(out.where(F.col("stt") < "2099")) == rows(expected)

    logins = dws.login_filter(pages).select("uid", "ts", "log_id")
    ls = _replay(spark, logins, os.path.join(tmp, "in2"),
                 [{"uid": "zz", "ts": FAR, "log_id": -1}, {"uid": "zz", "ts": FAR + 86_400_000, "log_id": -2}],
                 ["ts", "log_id"])
    lo = run_to_memory(jobs.login_window_stream(ls), "login_win_stream", os.path.join(tmp, "c2"))
    assert rows(lo.where(F.col("stt") < "2099")) == rows(dws.login_window(
        pages, "1 second"))


def test_cart_user_window_stream_equals_batch(spark, tmp):
    from tillstream.operators import facts
    carts = facts.cart_add(drv.cart_changes(drv.table(spark, SF, "events")))
    sent = [{"id": "zz", "user_id": "zz", "sku_id": "0", "sku_num": "1", "ts_ms": FAR},
            {"id": "zy", "user_id": "zz", "sku_id": "0", "sku_num": "1", "ts_ms": FAR + 86_400_000}]
    stream = _replay(spark, carts, os.path.join(tmp, "in"), sent, ["ts_ms", "id"])
    out = run_to_memory(jobs.cart_user_window_stream(stream), "cart_stream", os.path.join(tmp, "c"))
    assert rows(out.where(F.col("stt") < "2099")) == rows(dws.cart_user_window(carts, "10 seconds"))


def test_sku_window_stream_equals_batch(spark, tmp):
    from tillstream.operators import facts
    from tillstream.plans.queries import DETAIL_ORDER
    ch = drv.order_changes(drv.table(spark, SF, "orders")).unionByName(
        drv.detail_changes(drv.table(spark, SF, "lineitem")))
    details = facts.order_detail(ch).dropDuplicates()
    base = {c: None for c in details.columns}
    sent = [dict(base, id="zz", sku_id="zz", ts_ms=FAR), dict(base, id="zy", sku_id="zz", ts_ms=FAR + 86_400_000)]
    stream = _replay(spark, details, os.path.join(tmp, "in"), sent, ["ts_ms", "id"])
    out = run_to_memory(jobs.sku_order_window_stream(stream, DETAIL_ORDER), "sku_stream",
                             os.path.join(tmp, "c"))
    got = rows(out.where(F.col("sku_id") != "zz"))
    expected = rows(dws.sku_order_window_batch(details, DETAIL_ORDER, None, "10 seconds"))
    norm = lambda rs: [tuple(float(x) if hasattr(x, "as_tuple") else x for x in r) for r in rs]
    assert norm(got) == norm(expected) and len(got) > 0


def test_province_window_stream_equals_batch(spark, tmp):
    from tillstream.operators import facts
    from tillstream.plans.queries import DETAIL_ORDER
    ch = drv.order_changes(drv.table(spark, SF, "orders")).unionByName(
        drv.detail_changes(drv.table(spark, SF, "lineitem")))
    details = facts.order_detail(ch).dropDuplicates()
    base = {c: None for c in details.columns}
    sent = [dict(base, id="zz", province_id="zz", ts_ms=FAR),
            dict(base, id="zy", province_id="zz", ts_ms=FAR + 86_400_000)]
    stream = _replay(spark, details, os.path.join(tmp, "in"), sent, ["ts_ms", "id"])
    out = run_to_memory(jobs.province_order_window_stream(stream, DETAIL_ORDER), "prov_stream",
                             os.path.join(tmp, "c"))
    got = rows(out.where(F.col("province_id") != "zz"))
    expected = rows(dws.province_order_window_batch(details, DETAIL_ORDER, None, "1 second"))
    norm = lambda rs: [tuple(float(x) if hasattr(x, "as_tuple") else x for x in r) for r in rs]
    assert norm(got) == norm(expected) and len(got) > 0


def test_repair_stream_equals_batch(spark, tmp):
    pages = _pages(spark)
    cols = ["mid", "is_new", "ts", "log_id"]
    stream = _replay(spark, pages.select(*cols), os.path.join(tmp, "in"), [], ["ts", "log_id"])
    out = run_to_memory(jobs.repair_stream(stream, cols), "repair_stream", os.path.join(tmp, "c"))
    log = pages.select(F.struct("mid", "is_new").alias("common"), "ts", "log_id")
    expected = sequence.repair_is_new(log).select("common.mid", "common.is_new", "ts", "log_id")
    assert rows(out, "mid", "is_new", "ts", "log_id") == rows(expected)


def _fact_inputs(spark, tmp, tables, key):
    """The change stream of some tables, replayed with far-future records."""
    ch = drv.order_table_changes(spark, SF).where(F.col("source")["table"].isin(*tables))
    sentinels = []
    for t in (FAR, FAR + 10 * 86_400_000):
        for table in tables:
            img = {"id": "zz", "order_id": "zz", "order_status": key, "payment_status": "1602"}
            sentinels.append({"before": {"id": "zz", "order_status": "1001", "payment_status": "1601"},
                              "after": img, "source": {"table": table, "ts_ms": str(t)},
                              "op": "c" if table == "order_refund_info" else "u", "ts_ms": t})
    return ch, _replay(spark, ch, os.path.join(tmp, "changes"), sentinels, ["ts_ms"])


def _detail_input(spark, tmp):
    from tillstream.operators import facts
    ch = drv.order_changes(drv.table(spark, SF, "orders")).unionByName(
        drv.detail_changes(drv.table(spark, SF, "lineitem")))
    d = facts.order_detail(ch)
    far = [{**{c: None for c in d.columns}, "id": "zz", "order_id": "zz", "ts_ms": t}
           for t in (FAR, FAR + 10 * 86_400_000)]
    return d, _replay(spark, d, os.path.join(tmp, "details"), far, ["ts_ms", "id"])


def test_cancel_and_payment_streams_equal_batch(spark, tmp):
    from tillstream.operators import facts
    from tillstream.sources import dims
    details, detail_stream = _detail_input(spark, tmp)
    ch, stream = _fact_inputs(spark, tmp, ["order_info", "payment_info"], "1003")
    out = run_to_memory(jobs.order_cancel_stream(stream, detail_stream), "cancel_s", os.path.join(tmp, "c1"))
    want = rows(facts.order_cancel(ch, details))
    assert rows(out.where("id != 'zz'")) == want and want
    out = run_to_memory(jobs.payment_stream(stream, detail_stream, dims.base_dic(spark)), "pay_s",
                        os.path.join(tmp, "c2"))
    want = rows(facts.payment_success(ch, details, dims.base_dic(spark)))
    assert rows(out.where("order_id != 'zz'")) == want and want


def test_refund_and_comment_streams_equal_batch(spark, tmp):
    from tillstream.operators import facts
    from tillstream.sources import dims
    ch, stream = _fact_inputs(spark, tmp, ["order_info", "order_refund_info"], "1005")
    out = run_to_memory(jobs.refund_stream(stream, dims.base_dic(spark)), "refund_s", os.path.join(tmp, "c1"))
    want = rows(facts.refund(ch, dims.base_dic(spark)))
    assert rows(out.where("order_id != 'zz'")) == want and want
    # stateless facts run unchanged on a stream
    c = drv.comment_changes(drv.table(spark, SF, "documents"))
    s = _replay(spark, c, os.path.join(tmp, "comments"), [], ["ts_ms"])
    out = run_to_memory(facts.comment_fact(s, dims.base_dic(spark)), "comment_s", os.path.join(tmp, "c2"))
    assert rows(out) == rows(facts.comment_fact(c, dims.base_dic(spark)))
    k = drv.cart_changes(drv.table(spark, SF, "events"))
    s = _replay(spark, k, os.path.join(tmp, "carts"), [], ["ts_ms"])
    out = run_to_memory(facts.cart_add(s), "cart_s2", os.path.join(tmp, "c3"))
    assert rows(out) == rows(facts.cart_add(k))


def test_routing_reads_the_configuration_per_batch(spark, tmp):
    from tillstream.operators import cdc
    from tillstream.sources import config as cfg
    ch = drv.user_changes(drv.table(spark, SF, "customer"))
    stream = _replay(spark, ch, os.path.join(tmp, "in"), [], ["ts_ms"])
    full = cfg.config_log(spark, cfg.DIM_CONFIG_LOG)
    calls = []
    q = jobs.dim_route_job(stream, lambda: calls.append(1) or full, os.path.join(tmp, "dim"),
                           os.path.join(tmp, "c1"), {"availableNow": True})
    q.awaitTermination()
    got = spark.read.json(os.path.join(tmp, "dim"))
    want = cdc.route_dims(ch, full)
    assert calls and sorted(r.row_key for r in got.collect()) == sorted(r.row_key for r in want.collect())
    cart = drv.cart_changes(drv.table(spark, SF, "events"))
    stream = _replay(spark, cart, os.path.join(tmp, "in2"), [], ["ts_ms"])
    facts_cfg = cfg.config_log(spark, cfg.DWD_CONFIG_LOG)
    q = jobs.fact_route_job(stream, lambda: facts_cfg, os.path.join(tmp, "fact"), os.path.join(tmp, "c2"),
                            {"availableNow": True})
    q.awaitTermination()
    assert spark.read.json(os.path.join(tmp, "fact")).count() == cdc.route_facts(cart, facts_cfg).count() > 0


def test_processors_with_a_ttl(spark, tmp):
    """State that expires: the processors start and give the batch rows."""
    hour = 3_600_000
    cols = ["mid", "is_new", "ts", "log_id"]
    recs = [(f"m{k % 5}", str(k % 2), 1_704_067_200_000 + k * 9 * hour, k) for k in range(30)]
    pages = spark.createDataFrame(recs, "mid string, is_new string, ts bigint, log_id bigint")
    s = _replay(spark, pages, os.path.join(tmp, "r"), [], ["ts", "log_id"])
    out = run_to_memory(jobs.repair_stream(s, cols, ttl_ms=hour), "ttl_b", os.path.join(tmp, "b"), True)
    want = sequence.repair_is_new(pages.withColumn("common", F.struct("mid", "is_new")))
    assert rows(out, "log_id", "is_new") == rows(want, "log_id", "common.is_new")
    names = ["id", "amt", "ts_ms"]
    details = spark.createDataFrame([(f"d{k % 4}", str(k - 3), k // 2) for k in range(12)],
                                    "id string, amt string, ts_ms bigint")
    s = _replay(spark, details, os.path.join(tmp, "d"), [], ["ts_ms"])
    out = run_to_memory(jobs.retraction_stream(s, "id", names, ["amt"], ["ts_ms", "amt"], hour), "ttl_c",
                        os.path.join(tmp, "c"), True)
    want = sequence.retract_duplicates(details, "id", ["amt"], ["ts_ms", "amt"])
    key = ["id", "ts_ms", "sign", F.col("amt").cast("decimal(20,4)")]
    assert rows(out.select(*key)) == rows(want.select(*key))


def test_running_profile_stream_equals_batch(spark, tmp):
    from tillstream.streaming.processors import PROFILE_ROW, RunningProfile
    items = [None, "small size 1", "red widget"]
    recs = [("-1" if k % 3 == 0 else f"u{k % 4}", 1_704_067_200_000 + k * 17_000, ["iOS", "Android"][k % 2],
             "oppo", "m1", "Apple", items[k % 3]) for k in range(60)]
    proj = spark.createDataFrame(recs, "uid string, ts bigint, os string, ch string, md string, ba string, "
                                       "search_item string")
    s = _replay(spark, proj, os.path.join(tmp, "in"), [], ["ts", "os", "search_item"])
    out = run_to_memory(s.groupBy("uid").transformWithStateInPandas(
        RunningProfile(ttl_ms=3_600_000), PROFILE_ROW, "Append", "ProcessingTime"), "profile_s",
        os.path.join(tmp, "c"), True)
    last = label.last_per_window(out, "uid", "event_ts", 60_000, ["event_ts", "pv"])
    want = label.running_profile(proj)
    cols = ["uid", "window_start_ms", "pv", "os", F.col("ts").cast("string"), "last_search"]
    assert rows(last.select(*cols)) == rows(want.select(*cols))
