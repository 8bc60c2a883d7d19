import json
import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tillstream.operators import logs
from tillstream.sinks.writers import (to_json_value, write_batch_append, write_routed)
from tillstream.sources import files, jdbc, streams

LOGS = [
    '{"common":{"mid":"m1","uid":"7","vc":"v2.1.132","ch":"oppo","ar":"30","is_new":"1","os":"Android 13.0",'
    '"md":"x1","ba":"oppo","sid":"s1"},"page":{"page_id":"home","during_time":9000},'
    '"displays":[{"item":"3"},{"item":"4"}],"ts":1745286625000}',
    '{"common":{"mid":"m1","uid":"7","vc":"v2.1.132","ch":"oppo","ar":"30","is_new":"1","os":"Android 13.0",'
    '"md":"x1","ba":"oppo","sid":"s1"},"page":{"page_id":"good_list","last_page_id":"search",'
    '"item":"5G phone","item_type":"keyword","during_time":4000},"actions":[{"action_id":"cart_add"}],'
    '"ts":1745286630000}',
    '{"common":{"mid":"m2","is_new":"0","os":"iOS 16"},"start":{"entry":"icon"},"err":{"code":"1"},'
    '"ts":1745286631000}',
    'not json',
]


def test_log_parse_and_split(spark):
    text = spark.createDataFrame([(v,) for v in LOGS], "value string")
    good, bad = logs.parse_log(text)
    assert good.count() == 3 and [r.value for r in bad.collect()] == ["not json"]
    parts = logs.split_log(good)
    counts = {k: v.count() for k, v in parts.items()}
    assert counts == {"err": 1, "start": 1, "display": 2, "action": 1, "page": 2}
    assert "err" not in parts["start"].columns and "displays" not in parts["page"].columns
    assert "ts" not in parts["action"].columns


def test_text_source_batch_and_page_log(spark, tmp):
    with open(os.path.join(tmp, "log.txt"), "w") as f:
        f.write("\n".join(LOGS) + "\n")
    text = streams.read_json_text(spark, tmp, streaming=False)
    assert text.count() == 4
    pages = streams.read_page_log(text)
    assert pages.count() == 2 and "et" in pages.columns


def test_jdbc_round_trip_derby(spark, tmp):
    url = f"jdbc:derby:{os.path.join(tmp, 'db')};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    typed = spark.createDataFrame([(110000, "北京", "北京市", "东城区")],
                                  "code bigint, province string, city string, area string")
    # explicit column types (the Derby dialect binds string NULLs as CLOB, so
    # nullable text goes to default-typed tables below)
    jdbc.write_jdbc(typed, url, "REGION_TYPED", batchsize=500, properties=props,
                    types="province VARCHAR(64), city VARCHAR(64), area VARCHAR(64)")
    nullable = spark.createDataFrame([(110000, "北京", "北京市", "东城区"), (120000, "天津", None, None)],
                                     "code bigint, province string, city string, area string")
    jdbc.write_jdbc(nullable, url, "REGION_CODE", batchsize=1, properties=props)
    back = jdbc.read_jdbc(spark, url, 'SELECT "code" AS "region_code", "province" FROM REGION_CODE',
                          camel=True, properties=props)
    assert [c.lower() for c in back.columns] == ["regioncode", "province"]
    assert rows(back) == [(110000, "北京"), (120000, "天津")]
    typed_back = jdbc.read_jdbc(spark, url, "SELECT * FROM REGION_TYPED", properties=props)
    assert rows(typed_back) == [(110000, "北京", "北京市", "东城区")]
    assert jdbc.snake_to_camel("sink_table") == "sinkTable"


def test_region_codes_words_weather(spark, tmp):
    with open(os.path.join(tmp, "codes.txt"), "w") as f:
        f.write("110101 北京,北京市,东城区\n120000 天津\n\n310115 上海,上海市,浦东新区\n")
    codes = files.load_region_codes(spark, os.path.join(tmp, "codes.txt"))
    assert rows(codes) == [(110101, "北京", "北京市", "东城区"), (120000, "天津", None, None),
                           (310115, "上海", "上海市", "浦东新区")]
    cities = files.city_list(codes, ["上海"])
    assert rows(cities, "code") == [(110101,)]
    with open(os.path.join(tmp, "words.txt"), "w") as f:
        f.write("hate\n  idiot \n\nhate\n")
    assert rows(files.load_words(spark, os.path.join(tmp, "words.txt"))) == [("hate",), ("idiot",)]
    payload = json.dumps({"status": "1", "info": "OK", "lives": [
        {"province": "北京", "city": "东城区", "weather": "晴", "reporttime": "2025-05-01 10:00:00"}]})
    resp = spark.createDataFrame([(110101, "北京", "北京市", None, payload),
                                  (120000, "天津", "天津市", "和平区", json.dumps({"status": "0"}))],
                                 "code bigint, province string, city string, area string, payload string")
    w = files.flatten_weather(resp).collect()
    assert len(w) == 1 and w[0].city == "东城区" and w[0].area == "东城区"
    assert str(w[0].report_time).startswith("2025-05-01 10:00:00")


def test_sinks_routed_and_append(spark, tmp):
    df = spark.createDataFrame([("dwd_a", "1"), ("dwd_b", "2")], "sink_table string, id string")
    write_routed(df, "sink_table", os.path.join(tmp, "routed"))
    assert sorted(os.listdir(os.path.join(tmp, "routed")))[:2] == ["_SUCCESS", "sink_table=dwd_a"] or \
        "sink_table=dwd_a" in os.listdir(os.path.join(tmp, "routed"))
    p = write_batch_append(df, os.path.join(tmp, "out"), 3)
    write_batch_append(df, os.path.join(tmp, "out"), 3)  # replay: same folder rewritten
    assert spark.read.parquet(p).count() == 2
    assert to_json_value(df, drop=["sink_table"]).first().value == '{"id":"1"}'
