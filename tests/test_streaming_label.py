"""The streaming label chain gives the batch chain's rows."""

import os

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming import FAR, SF, _replay, run_to_memory
from tillstream.operators import label
from tillstream.plans import queries as q
from tillstream.sources import dims
from tillstream.sources import driver as drv
from tillstream.streaming import jobs
from tillstream.streaming import label as stream

LATER = [FAR + k * 20 * 86_400_000 for k in range(3)]


def _logs(spark, tmp):
    proj = q._log_proj(spark, SF)
    far = [{**{c: None for c in proj.columns}, "uid": "zz", "os": "x", "ts": t} for t in LATER]
    return _replay(spark, proj, os.path.join(tmp, "logs"), far, ["ts", "uid"])


def _few_partitions(spark, run):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_profiles_equal_batch(spark, tmp):
    logs = _logs(spark, tmp)
    out = _few_partitions(spark, lambda: run_to_memory(
        stream.profile_stream(logs), "profiles_s", os.path.join(tmp, "c")))
    want = rows(q._profile(spark, SF))
    assert rows(out.where("uid != 'zz'").drop("et")) == want and want


def test_last_per_window_stream_equals_batch(spark, tmp):
    pv = q._pages(spark, SF).select("uid", "ts", "log_id", "page_id", "during_time")
    far = [{"uid": "zz", "ts": t, "log_id": -1, "page_id": "p", "during_time": 0} for t in LATER[:2]]
    s = jobs.with_event_time(_replay(spark, pv, os.path.join(tmp, "in"), far, ["ts"]))
    out = run_to_memory(jobs.last_per_window_stream(s, "uid", "et", "1 minute", ["ts", "log_id"]),
                        "last_s", os.path.join(tmp, "c"))
    want = label.last_per_window(pv, "uid", "ts", 60_000, ["ts", "log_id"])
    cols = want.columns
    # A row without a user is a key of its own on both sides.
    assert rows(out.where("uid is distinct from 'zz'"), *cols) == rows(want, *cols)


def test_age_band_stream_equals_batch(spark, tmp):
    changes = q._order_changes(spark, SF)
    images = [{"before": None, "after": {"id": "zz", "order_id": "zz", "user_id": "zz", "sku_id": "1"},
               "source": {"table": t, "ts_ms": str(ms)}, "op": "c", "ts_ms": ms}
              for ms in LATER for t in ("order_info", "order_detail")]
    orders = _replay(spark, changes, os.path.join(tmp, "orders"), images, ["ts_ms"])
    people = drv.user_changes(drv.table(spark, SF, "customer"))
    far = [{"before": None, "after": {"id": "zz"}, "source": {"table": "user_info"}, "op": "c", "ts_ms": t}
           for t in LATER]
    users = label.user_profile(_replay(spark, people, os.path.join(tmp, "users"), far, ["ts_ms"]), q.TODAY)
    mapping = label.sku_brand_category(dims.sku_dims(spark, SF), dims.category_compare(spark))
    chain = stream.age_band_stream(users, orders, _logs(spark, tmp), mapping, q._hier(spark, SF),
                                   dims.category_compare(spark), spark, retention="30 days")
    out = _few_partitions(spark, lambda: run_to_memory(chain, "age_s", os.path.join(tmp, "c")))
    want = rows(q.QUERIES["label_age_band"](spark, SF))
    assert rows(out.where("id != 'zz'")) == want and want
