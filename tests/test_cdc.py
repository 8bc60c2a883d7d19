import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillstream.operators import cdc
from tillstream.schemas import CONFIG
from tillstream.sinks.writers import current_table, rebucket, upsert_table

ENVELOPES = [
    '{"before":null,"after":{"id":1,"order_status":"1001"},"source":{"db":"shop","table":"order_info",'
    '"server_id":1,"ts_ms":1716812267000},"op":"c","ts_ms":1716812265698}',
    '{"before":{"id":1,"order_status":"1001"},"after":{"id":1,"order_status":"1003",'
    '"operate_time":"2024-05-27 20:18:31"},"source":{"db":"shop","table":"order_info","server_id":1,'
    '"ts_ms":1716812311000},"op":"u","ts_ms":1716812310215}',
    '{"before":{"id":1},"after":null,"source":{"db":"shop","table":"order_info","server_id":1,'
    '"ts_ms":1716812341000},"op":"d","ts_ms":1716812340475}',
    '{oops',
    '{}',
    '{"after":{},"source":{"table":"cart_info"},"op":"c","ts_ms":1,"extra":"unknown key"}',
]


def _text(spark):
    return spark.createDataFrame([(v,) for v in ENVELOPES], "value string")


def test_parse_envelope_good_and_bad(spark):
    good, bad = cdc.parse_envelope(_text(spark))
    assert good.count() == 4
    assert sorted(r.value for r in bad.collect()) == sorted(["{oops", "{}"])
    first = good.where(F.col("op") == "c").where(F.col("source")["table"] == "order_info").first()
    assert first.after == {"id": "1", "order_status": "1001"}


def test_ods_filter_and_row_image(spark):
    good, _ = cdc.parse_envelope(_text(spark))
    assert cdc.ods_filter(good).count() == 2                       # after null / empty dropped
    assert cdc.ods_filter(good, keep_deletes=True).count() == 3    # the delete is kept
    img = cdc.row_image(cdc.table_changes(good, "order_info")).select(
        "op", F.col("data")["order_status"].alias("s"), F.col("data")["id"].alias("id"))
    assert rows(img) == [("c", "1001", "1"), ("d", None, "1"), ("u", "1003", "1")]
    flat = cdc.row_image_flat(cdc.table_changes(good, "order_info", ["d"])).first()
    assert flat.data == {"id": "1", "op": "d", "tm_ms": "1716812340475"}


def _config(spark, rows_):
    return spark.createDataFrame(rows_, CONFIG)


def test_latest_config_insert_update_delete(spark):
    cfg = _config(spark, [
        ("a", "insert", "s1", None, "id", None, "c", 1),
        ("a", "insert", "s1", None, "id,x", None, "u", 2),
        ("b", "insert", "s2", None, "id", None, "c", 1),
        ("b", "insert", "s2", None, "id", None, "d", 5),
    ])
    got = cdc.latest_config(cfg).select("source_table", "sink_columns").collect()
    assert [(r.source_table, r.sink_columns) for r in got] == [("a", "id,x")]


def test_route_dims_prunes_and_keys_by_value(spark):
    changes = spark.createDataFrame([
        (None, {"tm_name": "Redmi", "create_time": "2021-12-14 00:00:00", "logo_url": "555", "id": "1"},
         {"table": "base_trademark"}, "r", 1),
        ({"id": "2", "tm_name": "Old"}, None, {"table": "base_trademark"}, "d", 2),
        (None, {"id": "9"}, {"table": "unknown"}, "c", 3),
        (None, {"id": "3", "a": "x"}, {"table": "no_prune"}, "c", 4),
    ], "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint")
    cfg = _config(spark, [
        ("base_trademark", None, "dim_tm", "info", "id,tm_name", "id", "c", 1),
        ("no_prune", None, "dim_np", "info", None, "id", "c", 1),
    ])
    got = {(r.sink_table, r.row_key, r.op): r.data for r in cdc.route_dims(changes, cfg).collect()}
    assert got == {("dim_tm", "1", "r"): {"tm_name": "Redmi", "id": "1"},
                   ("dim_tm", "2", "d"): {"id": "2", "tm_name": "Old"},
                   ("dim_np", "3", "c"): {"id": "3", "a": "x"}}


def test_route_facts_maps_source_type(spark):
    changes = spark.createDataFrame([
        (None, {"id": "1", "sku_num": "2", "x": "y"}, {"table": "cart_info"}, "c", 10),
        ({"sku_num": "1"}, {"id": "1", "sku_num": "3"}, {"table": "cart_info"}, "u", 11),
    ], "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint")
    cfg = _config(spark, [("cart_info", "insert", "dwd_cart", None, "id,sku_num", None, "c", 1),
                          ("cart_info", "change", "dwd_cart_upd", None, "id", None, "c", 1)])
    got = sorted((r.sink_table, json.dumps(r.data, sort_keys=True))
                 for r in cdc.route_facts(changes, cfg).collect())
    assert got == [("dwd_cart", json.dumps({"id": "1", "sku_num": "2", "ts_ms": "10"}, sort_keys=True)),
                   ("dwd_cart_upd", json.dumps({"id": "1", "ts_ms": "11"}, sort_keys=True))]


def test_upsert_latest_and_delete(spark):
    target = spark.createDataFrame([("1", "a", 1), ("2", "b", 1)], "id string, v string, ts bigint")
    batch = spark.createDataFrame([("1", "a2", 5, False), ("1", "a3", 7, False), ("2", "x", 3, True),
                                   ("3", "c", 2, False)], "id string, v string, ts bigint, d boolean")
    out = cdc.upsert(target, batch, ["id"], ["ts"], delete_col="d")
    assert rows(out, "id", "v") == [("1", "a3"), ("3", "c")]


def _kv(spark, *recs):
    return spark.createDataFrame(list(recs), "id string, v string, ts bigint, d boolean")


def test_upsert_table_is_idempotent(spark, tmp):
    b1 = _kv(spark, ("1", "a", 1, False), ("2", "b", 1, False))
    b2 = _kv(spark, ("1", "z", 2, False))
    for batch in (b1, b2, b2, b1):                                   # with replays
        upsert_table(spark, tmp, batch, ["id"], ["ts"], "d")
    assert rows(current_table(spark, tmp), "id", "v") == [("1", "z"), ("2", "b")]
    upsert_table(spark, tmp, _kv(spark, ("3", "c", 5, False)), ["id"], ["ts"], "d")
    assert rows(current_table(spark, tmp), "id", "v") == [("1", "z"), ("2", "b"), ("3", "c")]
    upsert_table(spark, tmp, _kv(spark).limit(0), ["id"], ["ts"], "d")
    assert current_table(spark, tmp).count() == 3


def test_upsert_table_keeps_max_version_out_of_order(spark, tmp):
    upsert_table(spark, tmp, _kv(spark, ("1", "new", 9, False), ("2", "x", 9, True)), ["id"], ["ts"], "d")
    upsert_table(spark, tmp, _kv(spark, ("1", "old", 3, False), ("2", "y", 4, False)), ["id"], ["ts"], "d")
    assert rows(current_table(spark, tmp), "id", "v") == [("1", "new")]
    assert rows(current_table(spark, tmp, tombstones=True), "id") == [("1",), ("2",)]


def test_upsert_table_rewrites_touched_buckets_only(spark, tmp):
    import glob
    many = _kv(spark, *[(str(k), "a", 1, False) for k in range(60)])
    upsert_table(spark, tmp, many, ["id"], ["ts"], "d", buckets=8)
    before = set(glob.glob(f"{tmp}/data/bucket=*/*.parquet"))
    upsert_table(spark, tmp, _kv(spark, ("7", "b", 2, False)), ["id"], ["ts"], "d")
    after = set(glob.glob(f"{tmp}/data/bucket=*/*.parquet"))
    assert len(before) == 8 and len(after) == 8 and len(before - after) == 1
    got = dict(rows(current_table(spark, tmp), "id", "v"))
    assert len(got) == 60 and got["7"] == "b" and got["8"] == "a"
    rebucket(spark, tmp, f"{tmp}/wide", ["id"], 20)
    upsert_table(spark, f"{tmp}/wide", _kv(spark, ("8", "c", 2, False)), ["id"], ["ts"], "d")
    wide = dict(rows(current_table(spark, f"{tmp}/wide"), "id", "v"))
    assert wide == {**got, "8": "c"} and len(glob.glob(f"{tmp}/wide/data/bucket=*")) > 8


def test_upsert_table_survives_a_half_done_write(spark, tmp):
    import glob
    import shutil
    many = _kv(spark, *[(str(k), "a", 1, False) for k in range(40)])
    upsert_table(spark, tmp, many, ["id"], ["ts"], "d", buckets=4)
    whole = rows(current_table(spark, tmp), "id", "v")
    # The writer died after it had written `pending` and removed a bucket.
    spark.read.parquet(f"{tmp}/data").write.parquet(f"{tmp}/pending")
    lost = glob.glob(f"{tmp}/data/bucket=*")[0]
    shutil.move(lost, f"{tmp}/moved")
    upsert_table(spark, tmp, _kv(spark, ("100", "n", 1, False)), ["id"], ["ts"], "d")
    assert rows(current_table(spark, tmp), "id", "v") == sorted([*whole, ("100", "n")])
    # A `pending` that was not finished is not read.
    _kv(spark, ("5", "half", 9, False)).withColumnRenamed("d", "__deleted").write.parquet(f"{tmp}/pending")
    shutil.move(f"{tmp}/pending/_SUCCESS", f"{tmp}/not_done")
    upsert_table(spark, tmp, _kv(spark, ("101", "n", 1, False)), ["id"], ["ts"], "d")
    assert dict(rows(current_table(spark, tmp), "id", "v"))["5"] == "a"


def test_upsert_table_is_never_taken_for_empty(spark, tmp):
    import shutil
    assert current_table(spark, tmp) is None
    upsert_table(spark, tmp, _kv(spark, ("1", "a", 1, False)), ["id"], ["ts"], "d")
    shutil.move(f"{tmp}/data", f"{tmp}/moved")
    with pytest.raises(Exception):
        current_table(spark, tmp).count()
    with pytest.raises(Exception):
        upsert_table(spark, tmp, _kv(spark, ("1", "b", 2, False)), ["id"], ["ts"], "d")


def test_delete_keys(spark):
    t = _kv(spark, ("1", "a", 1, False), ("2", "b", 1, False))
    assert rows(cdc.delete_keys(t, t.where("id = '1'"), ["id"]), "id") == [("2",)]


def test_images_with_clashing_keys(spark):
    src = {"table": "t", "ts_ms": "7"}
    c = spark.createDataFrame([({"op": "x", "tm_ms": "y", "ts_ms": "z", "id": "1"}, None, src, "c", 7)],
                              "after map<string,string>, before map<string,string>, "
                              "source map<string,string>, op string, ts_ms bigint")
    d = cdc.row_image_flat(c).first().data
    assert (d["op"], d["tm_ms"], d["id"]) == ("c", "7", "1")
    cfg = spark.createDataFrame([("t", "insert", "sink", "id,ts_ms", "id", "r", 1)],
                                "source_table string, source_type string, sink_table string, "
                                "sink_columns string, sink_row_key string, op string, ts_ms bigint")
    assert cdc.route_facts(c, cfg).first().data == {"id": "1", "ts_ms": "7"}
