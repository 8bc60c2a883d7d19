"""Routing configuration change logs used by the registered queries.

A deployment reads these from its configuration table (``read_jdbc``) or a
change stream; here they are fixed rules over the synthetic change stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.schemas import CONFIG
from tillstream.session import fixed_table

# Fixed values: (source_table, source_type, sink_table, sink_family, sink_columns,
# sink_row_key, op, ts_ms).  Later rows update or delete earlier ones.
DWD_CONFIG_LOG = [
    ("order_info", "insert", "dwd_order_created", None, "id,user_id,total_amount", None, "c", 1),
    ("order_info", "change", "dwd_order_status", None, "id,order_status,operate_time", None, "c", 1),
    ("order_info", "delete", "dwd_order_removed", None, "id", None, "c", 1),
    ("cart_info", "insert", "dwd_cart_raw", None, "id,user_id,sku_id,sku_num", None, "c", 1),
    ("cart_info", "insert", "dwd_cart_raw", None, "id,user_id,sku_num", None, "u", 2),
    ("payment_info", "change", "dwd_payment_raw", None, "order_id,payment_type", None, "c", 1),
    ("payment_info", "change", "dwd_payment_raw", None, None, None, "d", 3),
    ("comment_info", "insert", "dwd_comment_raw", None, None, None, "c", 1),
    ("warehouse_info", "insert", "dwd_never_seen", None, "id", None, "c", 1),
]

DIM_CONFIG_LOG = [
    ("user_info", None, "dim_user_info", "info", "id,name,user_level,gender", "id", "c", 1),
    ("user_info_sup_msg", None, "dim_user_sup", "info", "uid,height,weight", "uid", "c", 1),
    ("order_detail_coupon", None, "dim_coupon_use", "info", "order_detail_id,coupon_id",
     "order_detail_id", "c", 1),
    ("order_info", None, "dim_order_brief", "info", "id,user_id,order_status", "id", "c", 1),
    ("order_info", None, "dim_order_brief", "info", "id,order_status", "id", "u", 2),
    ("base_region", None, "dim_region", "info", "id,region_name", "id", "c", 1),
    ("base_region", None, "dim_region", "info", "id,region_name", "id", "d", 2),
]


def config_log(spark: SparkSession, rows) -> DataFrame:
    return fixed_table(spark, rows, CONFIG.simpleString()[len('struct<'):-1].replace(':', ' '))
