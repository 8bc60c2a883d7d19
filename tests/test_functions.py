import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstream import functions as fn
from tillstream.operators.scoring import pick_band, price_bucket

# (date, expected sign): the last day of each sign and the day after it.
ZODIAC = [
    ("2000-01-19", "摩羯座"), ("2000-01-20", "水瓶座"), ("2000-02-18", "水瓶座"), ("2000-02-19", "双鱼座"),
    ("2000-03-20", "双鱼座"), ("2000-03-21", "白羊座"), ("2000-04-19", "白羊座"), ("2000-04-20", "金牛座"),
    ("2000-05-20", "金牛座"), ("2000-05-21", "双子座"), ("2000-06-21", "双子座"), ("2000-06-22", "巨蟹座"),
    ("2000-07-22", "巨蟹座"), ("2000-07-23", "狮子座"), ("2000-08-22", "狮子座"), ("2000-08-23", "处女座"),
    ("2000-09-22", "处女座"), ("2000-09-23", "天秤座"), ("2000-10-23", "天秤座"), ("2000-10-24", "天蝎座"),
    ("2000-11-22", "天蝎座"), ("2000-11-23", "射手座"), ("2000-12-21", "射手座"), ("2000-12-22", "摩羯座"),
]


def test_zodiac_boundaries(spark):
    df = spark.createDataFrame([(dt.date.fromisoformat(d), s) for d, s in ZODIAC], "d date, s string")
    got = df.select("s", fn.zodiac_sign("d").alias("z")).collect()
    assert [(r.s, r.z) for r in got] == [(s, s) for _, s in ZODIAC]


@pytest.mark.parametrize("birth,today,age", [
    ("2000-06-15", "2025-06-15", 25),   # birthday today
    ("2000-06-16", "2025-06-15", 24),   # birthday tomorrow
    ("2000-02-29", "2025-02-28", 24),   # leap day, not reached
    ("2000-02-29", "2025-03-01", 25),
    ("2000-02-29", "2024-02-29", 24),
])
def test_age_years(spark, birth, today, age):
    df = spark.createDataFrame([(dt.date.fromisoformat(birth), dt.date.fromisoformat(today))],
                               "b date, t date")
    assert df.select(fn.age_years("b", "t")).first()[0] == age


def test_decade_and_epoch_day(spark):
    df = spark.createDataFrame([(9000,)], "d int")
    r = df.select(F.date_format(fn.epoch_day_to_date("d"), "yyyy-MM-dd").alias("b"),
                  fn.decade(fn.epoch_day_to_date("d")).alias("dec")).first()
    assert r.b == "1994-08-23" and r.dec == "1990"


def test_dates_and_text_to_date(spark):
    df = spark.createDataFrame([(1718278525000, "2024-06-13 11:35:25", "1718278525000")],
                               "ms bigint, t string, mt string")
    r = df.select(fn.ms_to_date("ms").alias("d"), fn.ms_to_datetime("ms").alias("dt"),
                  fn.ms_to_compact_date("ms").alias("ds"), fn.text_to_date("t").alias("d1"),
                  fn.text_to_date("mt").alias("d2"), fn.text_to_ms("t", 8).alias("m8"),
                  fn.whole_days_between(F.col("ms") + 8 * 86_400_000 - 1, "ms").alias("days")).first()
    assert (r.d, r.dt, r.ds, r.d1, r.d2) == ("2024-06-13", "2024-06-13 11:35:25", "20240613",
                                            "2024-06-13", "2024-06-13")
    assert r.m8 == 1718278525000 - 8 * 3_600_000
    assert r.days == 7


def test_tokens_last_first(spark):
    df = spark.createDataFrame([("小米手机 5G Phone",), ("",), (",",), ("a,b, c",), (None,)], "t string")
    got = df.select(fn.tokens("t").alias("k"), fn.last_token("t", ",").alias("l"),
                    fn.first_token("t", " ").alias("f")).collect()
    assert got[0].k == ["5g", "phone", "小米", "米手", "手机"]
    assert got[1].l is None and got[2].l is None
    assert got[3].l == " c"
    assert got[4].k is None or got[4].k == []


def test_map_keep_keys(spark):
    df = spark.createDataFrame(
        [({"tm_name": "Redmi", "create_time": "2021-12-14 00:00:00", "logo_url": "555", "id": "1"},
          "id,tm_name"), ({"a": "1"}, None)], "m map<string,string>, c string")
    got = df.select(fn.map_keep_keys("m", "c").alias("p")).collect()
    assert got[0].p == {"tm_name": "Redmi", "id": "1"}
    assert got[1].p == {"a": "1"}


@pytest.mark.parametrize("amount,bucket", [
    ("0", "0-1000"), ("1000", "0-1000"), ("1000.01", "1000-4000"), ("4000", "1000-4000"),
    ("4000.01", "other"), ("-1", "other")])
def test_price_bucket(spark, amount, bucket):
    df = spark.createDataFrame([(amount,)], "a string")
    assert df.select(price_bucket("a")).first()[0] == bucket


def test_pick_band_ties_and_zero(spark):
    df = spark.createDataFrame([(0.1, 0.3, 0.3, 0.0, 0.0, 0.0), (0.0,) * 6],
                               ", ".join(f"c{i} double" for i in range(6)))
    got = df.select(pick_band([F.col(f"c{i}") for i in range(6)])).collect()
    assert [r[0] for r in got] == ["25-29", "18-24"]


def test_keyword_table_function_matches_builtin(spark):
    from tillstream.functions.text import register_keywords
    register_keywords(spark)
    spark.createDataFrame([(1, "小米手机 5G Phone"), (2, "运动鞋 跑步"), (3, None)], "id int, item string") \
        .createOrReplaceTempView("kw_items")
    sql = spark.sql("SELECT id, k.word FROM kw_items, LATERAL keywords(kw_items.item) k")
    builtin = spark.table("kw_items").select("id", F.explode(fn.tokens("item")).alias("word"))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, builtin.collect()))
    plan = sql._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "Python" not in plan and "Join" not in plan
