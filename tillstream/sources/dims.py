"""Dimension tables.

The product, brand, category and province dimensions are derived from the
driver's ``part`` and ``nation`` tables (a distinct projection each, so they
grow with the data and are joined by size-checked broadcast or by shuffle).
The code dictionary is a fixed table, as a warehouse's ``base_dic`` is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import fixed_table
from tillstream.sources.driver import table

# Dictionary codes used by the synthetic change stream.  Code
# 1204 (an appraisal) is deliberately absent so inner lookups drop it.
BASE_DIC = [
    ("1101", "alipay"),
    ("1102", "wechat pay"),
    ("1103", "bank card"),
    ("1201", "good"),
    ("1202", "neutral"),
    ("1203", "bad"),
    ("1301", "quality issue"),
    ("1302", "wrong size"),
    ("1303", "changed mind"),
    ("1501", "refund only"),
    ("1502", "return and refund"),
]


# Trademark names by brand number mod 10, and the search
# category of each top-level category (category_compare_dic).
TRADEMARK_NAMES = ["苹果", "欧莱雅", "香奈儿", "Redmi", "联想", "长粒香", "金沙河", "小米", "华为", "耐克"]
CATEGORY_COMPARE = [
    ("group S", "时尚与潮流"),
    ("group P", "性价比"),
    ("group M", "健康与养生"),
    ("group L", "家庭与育儿"),
    ("group E", "科技与数码"),
]


def category_compare(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, CATEGORY_COMPARE, "category_name string, search_category string")


def base_dic(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, BASE_DIC, "dic_code string, dic_name string")


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("sku_name"),
        (F.col("p_partkey") % 200).cast("string").alias("spu_id"),
        F.regexp_extract("p_brand", r"#(\d+)", 1).alias("tm_id"),
        F.concat_ws("_", F.col("p_type"), F.col("p_size") % 4).alias("category3_id"),
        F.col("p_type").alias("ptype"), (F.col("p_size") % 4).alias("psize"))


def _trademark(tm_id: str):
    return F.element_at(F.array(*[F.lit(n) for n in TRADEMARK_NAMES]), (F.col(tm_id).cast("int") % 10 + 1))


def sku_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole sku chain resolved per sku in one projection of ``part``: every
    level's id and name."""
    return _part(spark, sf_dir).select(
        "id", "sku_name", "spu_id", F.col("tm_id").alias("trademark_id"), "category3_id",
        F.concat(F.lit("spu_"), F.col("spu_id")).alias("spu_name"),
        _trademark("tm_id").alias("trademark_name"),
        F.concat(F.lower("ptype"), F.lit(" size "), F.col("psize")).alias("category3_name"),
        F.col("ptype").alias("category2_id"), F.lower("ptype").alias("category2_name"),
        F.substring("ptype", 1, 1).alias("category1_id"),
        F.concat(F.lit("group "), F.substring("ptype", 1, 1)).alias("category1_name"))


def sku_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """sku → spu → trademark → category3 → category2 → category1, from ``part``."""
    p = _part(spark, sf_dir)
    return {
        "sku": p.select("id", "sku_name", "spu_id", "tm_id", "category3_id"),
        "spu": p.select(F.col("spu_id").alias("id"),
                        F.concat(F.lit("spu_"), F.col("spu_id")).alias("spu_name")).distinct(),
        "trademark": p.select(F.col("tm_id").alias("id"), _trademark("tm_id").alias("tm_name")).distinct(),
        "category3": p.select(F.col("category3_id").alias("id"),
                              F.concat(F.lower("ptype"), F.lit(" size "), F.col("psize")).alias("name"),
                              F.col("ptype").alias("category2_id")).distinct(),
        "category2": p.select(F.col("ptype").alias("id"), F.lower("ptype").alias("name"),
                              F.substring("ptype", 1, 1).alias("category1_id")).distinct(),
        "category1": p.select(F.substring("ptype", 1, 1).alias("id"),
                              F.concat(F.lit("group "), F.substring("ptype", 1, 1)).alias("name"))
                      .distinct(),
    }


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
