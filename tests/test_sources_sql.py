"""SQL tables and jobs, point reads, and the small readers and writers."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming import SF, _replay, run_to_memory
from tillstream.operators import dws, facts
from tillstream.plans import queries as q
from tillstream.schemas import ORDER_DETAIL_FACT
from tillstream.sinks import writers
from tillstream.sources import dims, files, jdbc, sql, streams
from tillstream.sources import driver as drv
from tillstream.streaming import jobs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sql_jobs_equal_the_dataframe_jobs(spark):
    changes, dic = drv.table_branches(spark, SF), dims.base_dic(spark)
    sql.register_tables(spark, changes, dic, q._log(spark, SF))
    for job, frame in ((sql.cart_add(spark), facts.cart_add(changes)),
                       (sql.comment_fact(spark), facts.comment_fact(changes, dic)),
                       (sql.refund(spark), facts.refund(changes, dic)),
                       (sql.keyword_count(spark), dws.keyword_window(q._pages(spark, SF)))):
        want = rows(frame)
        assert rows(job, *frame.columns) == want and want
        assert "Python" not in _plan(job) and "NestedLoop" not in _plan(job)
    narrowed = jdbc.run_sql(spark, "SELECT count(*) AS n FROM topic_db WHERE source['table'] = :t", {"t": "cart_info"})
    assert narrowed.first().n == changes.where("source['table'] = 'cart_info'").count() > 0


def test_a_sql_job_on_a_stream(spark, tmp):
    changes = drv.cart_changes(drv.table(spark, SF, "events"))
    sql.register_tables(spark, _replay(spark, changes, os.path.join(tmp, "in"), [], ["ts_ms"]))
    job = sql.cart_add(spark)
    assert job.isStreaming
    out = run_to_memory(job, "cart_sql", os.path.join(tmp, "ck"))
    assert rows(out) == rows(facts.cart_add(changes))


def test_point_read_opens_one_row_group(spark, tmp):
    path = os.path.join(tmp, "dim")
    dim = spark.range(20_000).select(F.format_string("k%06d", (F.col("id") * 7919) % 20_000).alias("id"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("v"))
    files.write_dimension(dim, path, "id", row_group_bytes=64 << 10, files=4)
    read = spark.read.parquet(path)
    one = files.point_lookup(read, "id", "k012345")
    assert one.count() == 1 and files.point_lookup(read, "id", "none").count() == 0
    assert "EqualTo(id,k012345)" in _plan(one)
    bounds = []
    for name in sorted(n for n in os.listdir(path) if n.endswith(".parquet")):
        meta = pq.ParquetFile(os.path.join(path, name)).metadata
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            bounds.append((stats.min, stats.max))
    assert len(bounds) > 4
    assert sum(low <= "k012345" <= high for low, high in bounds) == 1
    assert files.row_count(read) == 20_000


def test_scan_limit_gives_the_first_row_keys(spark):
    dim = spark.createDataFrame([(k, f"n{k}") for k in (5, 3, 9, 1, 7)], "id bigint, name string")
    got = files.scan_limit(dim, 3, "id")
    assert rows(got, "row_key", "id", "name") == [("1", 1, "n1"), ("3", 3, "n3"), ("5", 5, "n5")]
    assert "TakeOrderedAndProject" in _plan(got)


def test_changes_and_facts_are_read_with_their_schemas(spark):
    text = drv.changes_as_text(drv.cart_changes(drv.table(spark, SF, "events")))
    good, bad = streams.read_changes(text)
    assert good.columns == ["before", "after", "source", "op", "ts_ms"]
    assert good.count() + bad.count() == text.count() and bad.count() > 0
    details = q._details(spark, SF)
    topic = writers.to_json_value(details)
    back = streams.read_fact(topic, ORDER_DETAIL_FACT)
    assert back.schema == ORDER_DETAIL_FACT and rows(back, *details.columns) == rows(details)
    broken = spark.createDataFrame([("nonsense",)], "value string")
    assert streams.read_fact(broken, ORDER_DETAIL_FACT).first().id is None


def test_serialisers_and_json_files(spark, tmp):
    df = spark.createDataFrame([("1", "a", "t1"), ("2", None, "t2")], "id string, v string, sink string")
    out = writers.serialize(df, lambda d: F.to_json(F.struct("id", "v")), lambda d: d["id"], lambda d: d["sink"])
    assert rows(out) == [("1", '{"id":"1","v":"a"}', "t1"), ("2", '{"id":"2"}', "t2")]
    assert writers.serialize(df, lambda d: d["v"]).first().key is None
    writers.write_json(df, os.path.join(tmp, "json"))
    assert rows(spark.read.schema(df.schema).json(os.path.join(tmp, "json"))) == rows(df)


def test_streaming_json_messages_on_files(spark, tmp):
    df = spark.createDataFrame([(str(k), k) for k in range(20)], "id string, ts bigint")
    s = _replay(spark, df, os.path.join(tmp, "in"), [{"id": "x", "ts": 99}], ["ts"])
    for _ in range(2):      # the second run finds nothing new
        jobs.json_topic_job(s, os.path.join(tmp, "out"), os.path.join(tmp, "ck"), drop=["ts"],
                            trigger={"availableNow": True}).awaitTermination()
    got = sorted(r.value for r in spark.read.text(os.path.join(tmp, "out")).collect())
    assert got == sorted([f'{{"id":"{k}"}}' for k in range(20)] + ['{"id":"x"}'])
