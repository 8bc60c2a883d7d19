"""Explicit schemas, one per topic.  Streams are never schema-inferred."""

from pyspark.sql import types as T

S = T.StringType()
MAP_SS = T.MapType(S, S)

# Change record: before / after row images, source metadata, op, ts_ms.
ENVELOPE = T.StructType([
    T.StructField("before", MAP_SS),
    T.StructField("after", MAP_SS),
    T.StructField("source", MAP_SS),
    T.StructField("op", S),
    T.StructField("ts_ms", T.LongType()),
])

COMMON = T.StructType([T.StructField(n, S) for n in
                       ["ar", "ba", "ch", "is_new", "md", "mid", "os", "sid", "uid", "vc"]])
PAGE = T.StructType([
    T.StructField("during_time", T.LongType()),
    T.StructField("item", S),
    T.StructField("item_type", S),
    T.StructField("last_page_id", S),
    T.StructField("page_id", S),
])

# Application log: the inner fields of start/err/displays/actions are never
# read by a job, so they stay string maps.
LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", MAP_SS),
    T.StructField("err", MAP_SS),
    T.StructField("displays", T.ArrayType(MAP_SS)),
    T.StructField("actions", T.ArrayType(MAP_SS)),
    T.StructField("ts", T.LongType()),
])

# Routing configuration rows (dimension and fact routing share one shape).
CONFIG = T.StructType([
    T.StructField("source_table", S),
    T.StructField("source_type", S),
    T.StructField("sink_table", S),
    T.StructField("sink_family", S),
    T.StructField("sink_columns", S),
    T.StructField("sink_row_key", S),
    T.StructField("op", S),
    T.StructField("ts_ms", T.LongType()),
])

# DWD order detail fact (all text, as published on the topic).
ORDER_DETAIL_FACT = T.StructType([T.StructField(n, S) for n in [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "date_id", "create_time", "sku_num",
    "split_original_amount", "split_activity_amount", "split_coupon_amount",
    "split_total_amount"]] + [T.StructField("ts_ms", T.LongType())])
