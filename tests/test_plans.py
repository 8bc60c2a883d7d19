"""Plan-shape checks: what Catalyst plans, not just what it returns."""

import re
from collections import Counter

import pytest

from tillstream.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

def _plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_change_stream_prunes_to_read_tables(spark):
    plan = _plan(spark, "cdc_table_filter")
    assert "orders.parquet" in plan
    for other in ["lineitem.parquet", "events.parquet", "documents.parquet", "customer.parquet"]:
        assert other not in plan


@pytest.mark.parametrize("name", ["cdc_parse", "dim_route", "dwd_route", "config_latest", "dws_sku_order",
                                  "dws_province_order", "log_split_counts", "log_etl", "dws_traffic_pv",
                                  "moderation_p1", "moderation_p0", "comment_order_join"])
def test_every_table_is_scanned_once(spark, name):
    scans = Counter(re.findall(r"FileScan parquet.*?/(\w+)\.parquet", _plan(spark, name)))
    assert scans and max(scans.values()) == 1


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "dwd_comment")
    assert "documents.parquet" in plan
    read = [l for l in plan.split("\n") if "ReadSchema" in l or "FileScan" in l]
    assert read and all("n_chars" not in l and "lang" not in l for l in read)


def test_interval_join_is_an_equi_join(spark):
    plan = _plan(spark, "interval_join_30m")
    assert ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan or "ShuffledHashJoin" in plan)
    assert "_ib" in plan  # the time-bucket key


def test_fixed_tables_are_broadcast(spark):
    plan = _plan(spark, "dwd_comment")
    assert "BroadcastHashJoin" in plan


def test_upsert_reads_target_and_batch_once(spark):
    assert _plan(spark, "upsert_latest").count("orders.parquet") == 2
    assert _plan(spark, "label_age_band").count("part.parquet") == 2     # one per lookup


@pytest.mark.parametrize("name", ["dws_sku_order", "dws_province_order"])
def test_latest_rows_need_no_window_per_id(spark, name):
    assert not re.search(r"^[ +:*()0-9-]*Window ", _plan(spark, name), re.M)


def test_versions_are_ranked_in_time_buckets(spark):
    parts = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(spark, "retract_dedup"))
    ranked = [p for p in parts if "_bucket" in p or "_part" in p]
    assert len(ranked) == 2


def test_traffic_window_hashes(spark):
    plan = _plan(spark, "dws_traffic_pv")
    assert "SortAggregate" not in plan and plan.count("events.parquet") == 1


def _exchanged(plan):
    """For every shuffle of the plan: its keys and the columns of its rows."""
    out = []
    lines = plan.split("\n")
    for k, line in enumerate(lines):
        m = re.search(r"Exchange hashpartitioning\((.*?), \d+\)", line)
        if m:
            out.append((m.group(1), " ".join(lines[k + 1:k + 3])))
    return out


@pytest.mark.parametrize("name", ["dws_sku_order", "dws_province_order", "retract_dedup", "dwd_order_cancel",
                                  "dwd_payment", "dwd_order_detail"])
def test_order_lines_cross_once_by_order_id(spark, name):
    by_order = [rows for keys, rows in _exchanged(_plan(spark, name)) if re.fullmatch(r"order_id#\d+", keys)]
    assert len(by_order) == 1 and "split_total_amount_n" in by_order[0]


@pytest.mark.parametrize("name,key", [("dwd_order_cancel", "oc_id"), ("dwd_payment", "pi_order_id")])
def test_events_meet_their_orders_before_the_lines(spark, name, key):
    joins = [l for l in _plan(spark, name).split("\n") if re.search(r"(HashJoin|SortMergeJoin) ", l)]
    lines = next(k for k, l in enumerate(joins) if "[order_id#" in l)
    assert any(key in l for l in joins[lines + 1:])          # deeper in the plan: earlier


@pytest.mark.parametrize("name", ["dws_sku_order", "retract_dedup"])
def test_columns_that_decide_nothing_do_not_move(spark, name):
    assert "create_time" not in _plan(spark, name)


@pytest.mark.parametrize("name", ["dws_sku_order", "dws_province_order"])
def test_window_texts_are_made_after_the_last_shuffle(spark, name):
    plan = _plan(spark, name)
    assert max(plan.find("Exchange"), 0) > plan.find(" AS stt") > 0
    assert any(keys.startswith("_start#") for keys, _ in _exchanged(plan))
