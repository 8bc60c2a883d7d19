"""The declared SQL tables and SQL forms of fact jobs (SRC-4 … SRC-6, UDX-1,
UDX-4).

``register_tables`` names a change stream (or batch), the dictionary and the
page log as views, and the keyword table function; a job is then SQL text over
these names.  The jobs below are the SQL forms of ``operators.facts`` and
``operators.dws``: both give the same rows, on batches and (but for the grouped
one, which then needs its watermark) on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.text import register_keywords
from tillstream.sources.jdbc import run_sql

TOPIC_DB, BASE_DIC, PAGE_LOG = "topic_db", "base_dic", "page_log"


def register_tables(spark: SparkSession, changes: DataFrame | None = None, dic: DataFrame | None = None,
                    log: DataFrame | None = None) -> None:
    """Views: ``topic_db`` (``before``, ``after``, ``source``, ``op``, ``ts_ms``),
    ``base_dic`` (``dic_code``, ``dic_name``) and ``page_log`` (``common``,
    ``page``, ``ts`` and the event time ``et``), and the function ``keywords``."""
    if changes is not None:
        changes.createOrReplaceTempView(TOPIC_DB)
    if dic is not None:
        dic.createOrReplaceTempView(BASE_DIC)
    if log is not None:
        log.where("page IS NOT NULL").withColumn("et", F.timestamp_millis("ts")).createOrReplaceTempView(PAGE_LOG)
    register_keywords(spark)


CART_ADD = """
SELECT after['id'] AS id, after['user_id'] AS user_id, after['sku_id'] AS sku_id,
       CASE WHEN op = 'c' THEN after['sku_num']
            ELSE CAST(try_cast(after['sku_num'] AS INT) - try_cast(before['sku_num'] AS INT) AS STRING)
       END AS sku_num,
       try_cast(source['ts_ms'] AS BIGINT) AS ts_ms
FROM topic_db
WHERE source['table'] = 'cart_info'
  AND (op = 'c' OR (op = 'u' AND before['sku_num'] IS NOT NULL
                    AND try_cast(after['sku_num'] AS INT) >= try_cast(before['sku_num'] AS INT)))
"""

COMMENT = """
SELECT after['id'] AS id, after['user_id'] AS user_id, after['sku_id'] AS sku_id,
       after['appraise'] AS appraise, dic_name AS appraise_name, after['comment_txt'] AS comment_txt,
       try_cast(source['ts_ms'] AS BIGINT) AS ts
FROM topic_db JOIN base_dic ON after['appraise'] = dic_code
WHERE source['table'] = 'comment_info'
"""

REFUND = """
WITH requests AS (
  SELECT after, try_cast(source['ts_ms'] AS BIGINT) AS ts_ms FROM topic_db
  WHERE source['table'] = 'order_refund_info' AND op = 'c'),
refunding AS (
  SELECT after['id'] AS order_id, after['province_id'] AS province_id FROM topic_db
  WHERE source['table'] = 'order_info' AND op = 'u' AND before['order_status'] IS NOT NULL
    AND after['order_status'] = '1005')
SELECT after['id'] AS id, after['user_id'] AS user_id, after['order_id'] AS order_id,
       after['sku_id'] AS sku_id, province_id,
       date_format(coalesce(try_to_timestamp(after['create_time']),
                            timestamp_millis(try_cast(after['create_time'] AS BIGINT))), 'yyyy-MM-dd') AS date_id,
       after['create_time'] AS create_time, after['refund_type'] AS refund_type_code,
       kind.dic_name AS refund_type_name, after['refund_reason_type'] AS refund_reason_type_code,
       reason.dic_name AS refund_reason_type_name, after['refund_reason_txt'] AS refund_reason_txt,
       after['refund_num'] AS refund_num, after['refund_amount'] AS refund_amount, ts_ms
FROM requests JOIN refunding ON after['order_id'] = refunding.order_id
JOIN base_dic kind ON after['refund_type'] = kind.dic_code
JOIN base_dic reason ON after['refund_reason_type'] = reason.dic_code
"""

KEYWORD_COUNT = """
SELECT date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
       date_format(w.start, 'yyyy-MM-dd') AS cur_date, keyword, count(*) AS keyword_count
FROM (SELECT window(et, '1 second') AS w, k.word AS keyword
      FROM page_log, LATERAL keywords(page.item) k
      WHERE page.last_page_id = 'search' AND page.item_type = 'keyword' AND page.item IS NOT NULL)
GROUP BY w, keyword
"""


def cart_add(spark: SparkSession) -> DataFrame:
    """PRJ-5 as SQL."""
    return run_sql(spark, CART_ADD)


def comment_fact(spark: SparkSession) -> DataFrame:
    """PRJ-11 + JN-6 as SQL."""
    return run_sql(spark, COMMENT)


def refund(spark: SparkSession) -> DataFrame:
    """PRJ-8 + JN-5 + JN-6 as SQL."""
    return run_sql(spark, REFUND)


def keyword_count(spark: SparkSession) -> DataFrame:
    """AGG-7 + JN-22 + UDX-1 as SQL."""
    return run_sql(spark, KEYWORD_COUNT)
