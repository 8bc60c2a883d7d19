"""Streaming moderation, dictionaries that change, and rows without a time."""

import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming import FAR, SF, _replay, _write, run_to_memory
from tillstream.operators import facts, moderation
from tillstream.plans import queries as q
from tillstream.sources import dims
from tillstream.sources import driver as drv
from tillstream.sources.refresh import Refreshed
from tillstream.streaming import jobs
from tillstream.streaming import moderation as stream

NOW = {"availableNow": True}
COLS = ["user_id", "consignee", "ts_ms", "ds", "msg", "is_violation", "violation_grade",
        "violation_msg"]


def _far(table, at, **image):
    return {"before": None, "after": {"id": "9999", "order_id": "9999", **image},
            "source": {"table": table, "ts_ms": str(at)}, "op": "c", "ts_ms": at}


def _moderation_inputs(spark, tmp):
    c, o = drv.comment_changes(drv.table(spark, SF, "documents")), drv.order_changes(drv.table(spark, SF, "orders"))
    times = [FAR, FAR + 86_400_000]
    return (_replay(spark, c, os.path.join(tmp, "c"), [_far("comment_info", t, comment_txt="z") for t in times],
                    ["ts_ms"]),
            _replay(spark, o, os.path.join(tmp, "o"), [_far("order_info", t) for t in times], ["ts_ms"]))


def test_moderation_stream_equals_batch(spark, tmp):
    comments, orders = _moderation_inputs(spark, tmp)
    job = stream.moderation_job(comments, orders, lambda: moderation.words_df(spark), os.path.join(tmp, "out"),
                                os.path.join(tmp, "ck"), trigger=NOW)
    job.awaitTermination()
    got = spark.read.parquet(os.path.join(tmp, "out")).where(F.col("ts_ms") < FAR)
    want = rows(q.QUERIES["moderation_p1"](spark, SF).select(*COLS))
    assert rows(got.withColumn("ds", F.col("ds").cast("string")), *COLS) == want and want
    assert any("ds=" in d for d, *_ in os.walk(os.path.join(tmp, "out")))


def test_a_word_added_between_batches_takes_effect(spark, tmp):
    minute = 60_000
    comments = [_far("comment_info", k * minute, id=str(k), order_id=str(k), user_id="1", comment_txt="a blorb b")
                for k in range(1, 7)]
    orders = [_far("order_info", k * minute, id=str(k), user_id="1") for k in range(1, 7)]
    for name, images in (("c", comments), ("o", orders)):
        for k, image in enumerate(images):
            _write(os.path.join(tmp, name), f"p{k}.json", [image])
    schema = drv.comment_changes(drv.table(spark, SF, "documents")).schema
    c, o = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(os.path.join(tmp, n))
            for n in ("c", "o"))
    calls = []

    def words():
        calls.append(1)
        return moderation.words_df(spark, ["hate"] if len(calls) < 5 else ["hate", "blorb"])

    stream.moderation_job(c, o, words, os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                          trigger=NOW).awaitTermination()
    got = spark.read.parquet(os.path.join(tmp, "out")).orderBy("ts_ms").collect()
    grades = [r.violation_grade for r in got]
    assert len(grades) >= 2 and grades[0] == "" and grades[-1] == "P1"


def test_large_dictionaries_find_the_same_words(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    listed = ["the", "tion", "License", "ing th", "zzzz", "e", "é", ". T", "verbe"]
    words = moderation.words_df(spark, listed)
    want = [(r.doc_id, sorted(w for w in listed if w in (r.text or ""))) for r in docs.collect()]
    small = moderation.find_words(docs, "text", words)
    assert "Exchange" not in small._jdf.queryExecution().executedPlan().toString()
    shape = lambda df: sorted((r.doc_id, list(r.found)) for r in df.collect())
    assert shape(small) == sorted(want)
    for longer in (listed, [w for w in listed if len(w) > 2]):
        w = moderation.words_df(spark, longer)
        expected = sorted((i, [x for x in f if x in longer]) for i, f in want)
        monkeypatch.setattr(moderation, "IN_ROW", 3)
        assert shape(moderation.find_words(docs, "text", w)) == expected
        monkeypatch.setattr(moderation, "IN_ROW_KEYS", 2)
        assert shape(moderation.find_words(docs, "text", w)) == expected
        monkeypatch.undo()


def test_rarest_gram_is_the_key(spark):
    words = spark.createDataFrame([("abcx",), ("abcy",), ("abc",), ("",), (None,)], "word string")
    table, n = moderation.keyed_words(words)
    assert n == 3 and rows(table) == [("abc", "abc"), ("abcx", "bcx"), ("abcy", "bcy")]
    assert moderation.keyed_words(words.where("word = ''")) is None


def test_moderation_reads_its_tables_once(spark):
    plan = q.QUERIES["moderation_p1"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for table in ("documents", "orders"):
        assert plan.count(f"{table}.parquet") == 1


def test_refreshed_reads_by_age(spark):
    now, images = [0.0], iter(range(10))
    dim = Refreshed(lambda: spark.createDataFrame([(next(images),)], "v int"), 60, lambda: now[0])
    assert dim().first().v == 0 and dim().first().v == 0
    now[0] = 59.0
    assert dim().first().v == 0
    now[0] = 60.0
    assert dim().first().v == 1 and dim.reads == 2


def _changing(spark, code):
    """The dictionary, then one in which the name of ``code`` is new."""
    old = dims.base_dic(spark)
    new = old.withColumn("dic_name", F.when(F.col("dic_code") == code, "renamed").otherwise(F.col("dic_name")))
    images = iter([old, new, new, new, new, new, new])
    return Refreshed(lambda: next(images), 0)


def test_comment_job_follows_the_dictionary(spark, tmp):
    c = drv.comment_changes(drv.table(spark, SF, "documents"))
    code = c.select(F.col("after")["appraise"].alias("a")).where("a is not null").first().a
    later = _far("comment_info", FAR, id="x77", user_id="1", sku_id="1", appraise=code, comment_txt="x")
    s = _replay(spark, c, os.path.join(tmp, "in"), [later], ["ts_ms"])
    jobs.comment_job(s, _changing(spark, code), os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                     NOW).awaitTermination()
    got = spark.read.parquet(os.path.join(tmp, "out")).drop("query", "batch")
    first = facts.comment_fact(c, dims.base_dic(spark))
    assert rows(got.where("id != 'x77'"), *first.columns) == rows(first)
    assert rows(got.where("id = 'x77'"), "appraise", "appraise_name") == [(code, "renamed")]


def test_refund_job_follows_the_dictionary(spark, tmp):
    ch = drv.order_table_changes(spark, SF).where(F.col("source")["table"].isin("order_info", "order_refund_info"))
    want = facts.refund(ch, dims.base_dic(spark))
    code = want.first().refund_type_code
    image = {"id": "r", "order_id": "r", "user_id": "1", "refund_type": code, "province_id": "1",
             "refund_reason_type": want.first().refund_reason_type_code, "order_status": "1005"}
    later = [{"before": {"id": "r", "order_status": "1001"}, "after": image, "op": op, "ts_ms": FAR,
              "source": {"table": t, "ts_ms": str(FAR)}} for t, op in (("order_info", "u"), ("order_refund_info", "c"))]
    s = _replay(spark, ch, os.path.join(tmp, "in"), [], ["ts_ms"])
    _write(os.path.join(tmp, "in"), "part-1.json", later)
    jobs.refund_job(s, _changing(spark, code), os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                    trigger=NOW).awaitTermination()
    got = spark.read.parquet(os.path.join(tmp, "out"))
    assert rows(got.where("id != 'r'"), *want.columns) == rows(want)
    assert rows(got.where("id = 'r'"), "refund_type_name") == [("renamed",)]


def test_payment_job_follows_the_dictionary(spark, tmp):
    ch = drv.order_table_changes(spark, SF).where(F.col("source")["table"] == "payment_info")
    details = facts.order_detail(drv.order_changes(drv.table(spark, SF, "orders")).unionByName(
        drv.detail_changes(drv.table(spark, SF, "lineitem"))))
    want = facts.payment_success(ch, details, dims.base_dic(spark))
    code = want.first().payment_type_code
    later = {"before": {"id": "p", "payment_status": "1601"}, "op": "u", "ts_ms": FAR,
             "after": {"id": "p", "order_id": "p", "payment_type": code, "payment_status": "1602"},
             "source": {"table": "payment_info", "ts_ms": str(FAR)}}
    line = {**{c: None for c in details.columns}, "id": "p", "order_id": "p", "ts_ms": FAR}
    s = _replay(spark, ch, os.path.join(tmp, "p"), [later], ["ts_ms"])
    d = _replay(spark, details, os.path.join(tmp, "d"), [line], ["ts_ms", "id"])
    jobs.payment_job(s, d, _changing(spark, code), os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                     trigger=NOW).awaitTermination()
    got = spark.read.parquet(os.path.join(tmp, "out"))
    assert rows(got.where("order_id != 'p'"), *want.columns) == rows(want)
    assert rows(got.where("order_id = 'p'"), "payment_type_name") == [("renamed",)]


def test_rows_without_a_time_and_late_rows_are_counted(spark, tmp):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    src = os.path.join(tmp, "in")
    _write(src, "p0.json", [{"k": "a", "ts": 100_000}, {"k": "b"}, {"k": "c", "ts": None}])
    _write(src, "p1.json", [{"k": "a", "ts": 500_000}])
    _write(src, "p2.json", [{"k": "late", "ts": 1_000}, {"k": "a", "ts": 501_000}])
    _write(src, "p3.json", [{"k": "z", "ts": FAR}])

    def source():
        return spark.readStream.schema("k string, ts bigint").option("maxFilesPerTrigger", 1).json(src)

    ev = jobs.with_event_time(source(), "ts", "10 seconds", counted="events")
    agg = ev.groupBy(F.window("et", "10 seconds"), "k").agg(F.count("*").alias("n"))
    query = (agg.select("k", "n").writeStream.format("memory").queryName("late_s").outputMode("append")
             .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(**NOW).start())
    query.awaitTermination()
    account = jobs.event_time_account(query)
    assert account == {"rows": 7, "untimed": 2, "late": 1}
    counted = rows(spark.table("late_s"))
    assert "late" not in {k for k, _ in counted}
    assert sum(n for _, n in counted) + 1 + account["untimed"] + account["late"] == account["rows"]
    jobs.quarantine_job(source(), "ts", os.path.join(tmp, "bad"), os.path.join(tmp, "ck2"),
                        trigger=NOW).awaitTermination()
    bad = spark.read.schema("k string, ts bigint").json(os.path.join(tmp, "bad"))
    assert rows(bad, "k") == [("b",), ("c",)]


def test_a_bad_source_time_does_not_stop_the_detail_stream(spark, tmp):
    ch = drv.order_changes(drv.table(spark, SF, "orders")).where(F.col("op") == "c").unionByName(
        drv.detail_changes(drv.table(spark, SF, "lineitem")))
    tables = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"]
    broken = [{**_far("order_detail", 5, id="bad"), "source": {"table": "order_detail", "ts_ms": "not a time"}}]
    far = [_far(t, FAR + k * 86_400_000, order_detail_id="9999") for k in range(2) for t in tables]
    s = _replay(spark, ch, os.path.join(tmp, "in"), [*broken, *far], ["ts_ms"])
    out = run_to_memory(jobs.order_detail_stream(s, "10 seconds", "0 seconds"), "od_bad", os.path.join(tmp, "ck"))
    assert rows(out.where("id not in ('9999', 'bad')")) == rows(facts.order_detail(ch))


def test_log_job_repairs_before_it_splits(spark, tmp):
    from tillstream.operators import logs, sequence
    text = drv.events_log_text(drv.table(spark, SF, "events")).select("value", "log_id")
    lone = spark.createDataFrame([('{"common":{"is_new":"1"},"start":{"entry":"icon"},"ts":5}', -5)],
                                 text.schema)
    text = text.unionByName(lone)
    stream_in = _replay(spark, text, os.path.join(tmp, "in"), [], ["log_id"])
    jobs.log_split_job(stream_in, os.path.join(tmp, "out"), os.path.join(tmp, "ck"), NOW,
                       tiebreak="log_id").awaitTermination()
    good, bad = logs.parse_log(text)
    parts = logs.split_log(sequence.repair_is_new(good, "log_id").drop("log_id"))
    shape = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)))).collect())
    for name, part in parts.items():
        got = spark.read.schema(part.schema).json(os.path.join(tmp, "out", name)).select(part.columns)
        assert shape(got) == shape(part) and part.limit(1).count(), name
    assert rows(spark.read.schema("value string").json(os.path.join(tmp, "out", "bad")), "value") == rows(bad, "value")
    before = logs.split_log(good.drop("log_id"))["page"]
    assert shape(before) != shape(parts["page"])    # the repair changed something
