"""DuckDB SQL oracles, one per registered query.

The CTEs below restate the adapters of ``tillstream.sources.driver`` in DuckDB
SQL, independently of the Spark code, so the check covers adapter and operator.
Epoch milliseconds truncate (``epoch_us // 1000``) as Spark does.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

EV = """
ev AS (
  SELECT event_id AS log_id, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ts
  FROM events)"""

PAGES = EV + """,
pages AS (
  SELECT log_id, ts, user_id, k, event_type,
    'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid,
    'v2.1.' || (k % 3) AS vc,
    ['xiaomi','oppo','vivo','huawei','web'][k % 5 + 1] AS ch,
    CAST(k % 7 AS VARCHAR) AS ar, CAST(k % 2 AS VARCHAR) AS is_new,
    CASE WHEN user_id % 3 = 0 THEN 'iOS 1' || (k % 3 + 5) || '.0'
         ELSE 'Android 1' || (k % 4) || '.0' END AS os,
    'md_' || (user_id % 7) AS md,
    ['Apple','Xiaomi','Huawei','Oppo'][user_id % 4 + 1] AS ba,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
         ELSE event_type END AS page_id,
    CASE WHEN k % 8 = 5 THEN 'login' WHEN k % 4 = 1 THEN 'home' WHEN k % 4 = 2 THEN 'search'
         WHEN k % 4 = 3 THEN 'good_detail' END
      AS last_page_id,
    CASE WHEN k % 4 = 2 THEN 'keyword' ELSE 'sku_id' END AS item_type,
    CASE WHEN k % 4 = 2 THEN ['小米手机','5G phone','small size 1','red widget','运动鞋 跑步',
                              'economy size 2','笔记本电脑','large size 3'][k % 8 + 1]
         ELSE CAST(k AS VARCHAR) END AS item,
    CAST(round(value * 1000) AS BIGINT) AS during_time
  FROM ev WHERE event_type <> 'signup')"""


def win(ts: str, size_ms: int) -> str:
    """stt, edt, cur_date of the tumbling window holding epoch-ms ``ts``."""
    ws = f"({ts} - {ts} % {size_ms})"
    return (f"strftime(epoch_ms({ws}), '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime(epoch_ms({ws} + {size_ms}), '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime(epoch_ms({ws}), '%Y-%m-%d') AS cur_date")


def day(ts: str) -> str:
    return f"strftime(epoch_ms({ts}), '%Y-%m-%d')"


ORACLE["dws_traffic_pv"] = f"""
WITH {PAGES},
flagged AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY mid, {day('ts')} ORDER BY ts, log_id) = 1
                 THEN 1 ELSE 0 END AS uv,
         CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv
  FROM pages)
SELECT {win('ts', 10000)}, vc, ch, ar, is_new,
       sum(uv) AS uv_ct, sum(sv) AS sv_ct, count(*) AS pv_ct, sum(during_time) AS dur_sum
FROM flagged
GROUP BY ALL
"""

# ------------------------------------------------------------ change stream
def money(cents: str) -> str:
    c = f"({cents})"
    return f"(CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0'))"


ORD = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus AS st, o_orderpriority AS prio, o_totalprice,
         CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(o_custkey % 25 AS VARCHAR) AS province_id,
         """ + money("CAST(round(o_totalprice * 100) AS BIGINT)") + """ AS total_amount,
         1704067200000 + o_orderkey * 60000 AS t0
  FROM orders)"""

LINES = """
dl0 AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS ep,
         CAST(round(l_discount * 100) AS BIGINT) AS disc, CAST(round(l_tax * 100) AS BIGINT) AS tax,
         CAST(l_quantity AS BIGINT) AS q
  FROM lineitem),
dl AS (
  SELECT l_orderkey || '_' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, 'sku_' || l_partkey AS sku_name,
         CAST(q AS VARCHAR) AS sku_num,
         """ + money("(ep + q // 2) // q") + """ AS order_price,
         """ + money("(ep * (100 - disc) + 50) // 100") + """ AS split_total_amount,
         """ + money("(ep * disc + 50) // 100") + """ AS split_activity_amount,
         """ + money("(ep * tax + 50) // 100") + """ AS split_coupon_amount,
         disc, tax, 1704067200000 + l_orderkey * 60000 + l_linenumber * 1000 AS t
  FROM dl0)"""


def fmt(ms: str) -> str:
    return f"strftime(epoch_ms({ms}), '%Y-%m-%d %H:%M:%S')"


DETAIL_FACT = ORD + "," + LINES + f""",
act AS (SELECT id AS act_id, CAST(disc AS VARCHAR) AS activity_id,
               CAST(disc * 10 AS VARCHAR) AS activity_rule_id FROM dl WHERE disc >= 5),
cou AS (SELECT id AS cou_id, CAST(tax AS VARCHAR) AS coupon_id FROM dl WHERE tax >= 6),
od AS (
  SELECT dl.id, dl.order_id, o.user_id, dl.sku_id, dl.sku_name, o.province_id,
         act.activity_id, act.activity_rule_id, cou.coupon_id,
         strftime(epoch_ms(dl.t), '%Y-%m-%d') AS date_id, {fmt('dl.t')} AS create_time,
         dl.sku_num,
         CAST(CAST(dl.sku_num AS DECIMAL(16,2)) * CAST(dl.order_price AS DECIMAL(16,2)) AS VARCHAR)
           AS split_original_amount,
         dl.split_activity_amount, dl.split_coupon_amount, dl.split_total_amount, dl.t AS ts_ms
  FROM dl JOIN o ON dl.order_id = o.id
  LEFT JOIN act ON dl.id = act.act_id
  LEFT JOIN cou ON dl.id = cou.cou_id)"""

DIC = """
dic(dic_code, dic_name) AS (VALUES ('1101','alipay'), ('1102','wechat pay'), ('1103','bank card'),
  ('1201','good'), ('1202','neutral'), ('1203','bad'), ('1301','quality issue'),
  ('1302','wrong size'), ('1303','changed mind'), ('1501','refund only'),
  ('1502','return and refund'))"""

CHANGE_META = ORD + "," + LINES + "," + EV + """,
meta AS (
  SELECT 'order_info' AS tbl, 'c' AS op, t0 AS ts_ms FROM o
  UNION ALL SELECT 'order_info', 'u', t0 + 600000 FROM o WHERE st = 'F'
  UNION ALL SELECT 'order_info', 'u', t0 + 1800000 FROM o WHERE st = 'P'
  UNION ALL SELECT 'order_info', 'u', t0 + 259200000 FROM o WHERE st = 'F' AND prio = '1-URGENT'
  UNION ALL SELECT 'order_info', 'd', t0 + 86400000 FROM o WHERE st = 'P' AND prio = '5-LOW'
  UNION ALL SELECT 'payment_info', 'u', t0 + 600000 FROM o WHERE st = 'F'
  UNION ALL SELECT 'order_refund_info', 'c', t0 + 259200000 FROM o WHERE st = 'F' AND prio = '1-URGENT'
  UNION ALL SELECT 'order_detail', 'c', t FROM dl
  UNION ALL SELECT 'order_detail_activity', 'c', t FROM dl WHERE disc >= 5
  UNION ALL SELECT 'order_detail_coupon', 'c', t FROM dl WHERE tax >= 6
  UNION ALL SELECT 'cart_info', 'c', ts FROM ev WHERE event_type = 'click'
  UNION ALL SELECT 'cart_info', 'u', ts FROM ev WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT 'comment_info', 'c', 1704067200000 + doc_id * 900000 + 20000 + (doc_id % 50) * 1000 FROM documents
  UNION ALL SELECT 'user_info', 'c', 1704067200000 + c_custkey * 60000 FROM customer
  UNION ALL SELECT 'user_info_sup_msg', 'c',
                   1704067200000 + c_custkey * 60000 + (c_custkey % 61) * 60000 FROM customer)"""

ORACLE["cdc_parse"] = f"""
WITH {CHANGE_META}
SELECT tbl, op, count(*) AS n_records FROM meta WHERE ts_ms % 97 <> 0 GROUP BY tbl, op
UNION ALL
SELECT '__corrupt__', NULL, count(*) FROM meta WHERE ts_ms % 97 = 0
"""

ORACLE["cdc_table_filter"] = f"""
WITH {ORD}
SELECT id, '1001' AS old_status, '1002' AS new_status, t0 + 600000 AS ts_ms FROM o WHERE st = 'F'
UNION ALL SELECT id, '1001', '1003', t0 + 1800000 FROM o WHERE st = 'P'
UNION ALL SELECT id, '1002', '1005', t0 + 259200000 FROM o WHERE st = 'F' AND prio = '1-URGENT'
"""

ORACLE["cdc_row_image"] = f"""
WITH {ORD}
SELECT id, 'c' AS op, '1001' AS order_status, t0 AS ts_ms FROM o
UNION ALL SELECT id, 'u', '1002', t0 + 600000 FROM o WHERE st = 'F'
UNION ALL SELECT id, 'u', '1003', t0 + 1800000 FROM o WHERE st = 'P'
UNION ALL SELECT id, 'u', '1005', t0 + 259200000 FROM o WHERE st = 'F' AND prio = '1-URGENT'
UNION ALL SELECT id, 'd', '1003', t0 + 86400000 FROM o WHERE st = 'P' AND prio = '5-LOW'
"""


def _img(*pairs: tuple[str, str]) -> str:
    items = ", ".join(f"'{k}=' || ({v})" for k, v in pairs)
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), ';')"


ROUTED = ORD + "," + EV + f""",
routed AS (
  SELECT 'dwd_order_created' AS sink_table, t0 AS ts_ms, 4 AS n_cols,
         {_img(('id', 'id'), ('user_id', 'user_id'), ('total_amount', 'total_amount'),
               ('ts_ms', 't0'))} AS image FROM o
  UNION ALL
  SELECT 'dwd_order_status', t, 4,
         {_img(('id', 'id'), ('order_status', 's'), ('operate_time', fmt('t')), ('ts_ms', 't'))}
  FROM (SELECT id, '1002' AS s, t0 + 600000 AS t FROM o WHERE st = 'F'
        UNION ALL SELECT id, '1003', t0 + 1800000 FROM o WHERE st = 'P'
        UNION ALL SELECT id, '1005', t0 + 259200000 FROM o WHERE st = 'F' AND prio = '1-URGENT')
  UNION ALL
  SELECT 'dwd_cart_raw', ts, 4,
         {_img(('id', 'log_id'), ('user_id', 'user_id'), ('sku_num', 'k % 5 + 1'), ('ts_ms', 'ts'))}
  FROM ev WHERE event_type = 'click'
  UNION ALL
  SELECT 'dwd_comment_raw', t, 10,
         {_img(('id', 'doc_id'), ('user_id', 'doc_id % 1500'), ('nick_name', "'nick_' || (doc_id % 1500)"),
               ('sku_id', 'doc_id % 2000'), ('spu_id', 'doc_id % 200'), ('order_id', 'doc_id * 15'),
               ('appraise', "'120' || (doc_id % 4 + 1)"), ('comment_txt', 'text'),
               ('create_time', fmt('t')), ('ts_ms', 't'))}
  FROM (SELECT *, 1704067200000 + doc_id * 900000 + 20000 + (doc_id % 50) * 1000 AS t FROM documents))"""

ORACLE["config_latest"] = f"""
WITH {ROUTED}
SELECT sink_table, count(*) AS n_rows, max(n_cols) AS max_cols FROM routed GROUP BY sink_table
"""

ORACLE["dwd_route"] = f"""
WITH {ROUTED}
SELECT sink_table, image, ts_ms FROM routed
"""

ORACLE["dim_route"] = f"""
WITH {ORD}, {LINES},
cu AS (SELECT *, 1704067200000 + c_custkey * 60000 AS t FROM customer),
oi AS (
  SELECT id, 'c' AS op, '1001' AS s, t0 AS t FROM o
  UNION ALL SELECT id, 'u', '1002', t0 + 600000 FROM o WHERE st = 'F'
  UNION ALL SELECT id, 'u', '1003', t0 + 1800000 FROM o WHERE st = 'P'
  UNION ALL SELECT id, 'u', '1005', t0 + 259200000 FROM o WHERE st = 'F' AND prio = '1-URGENT'
  UNION ALL SELECT id, 'd', '1003', t0 + 86400000 FROM o WHERE st = 'P' AND prio = '5-LOW')
SELECT 'dim_user_info' AS sink_table, CAST(c_custkey AS VARCHAR) AS row_key, 'c' AS op,
       {_img(('id', 'c_custkey'), ('name', 'c_name'), ('user_level', 'c_custkey % 5 + 1'),
             ('gender', "CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END"))} AS image,
       t AS ts_ms
FROM cu
UNION ALL
SELECT 'dim_user_sup', CAST(c_custkey AS VARCHAR), 'c',
       {_img(('uid', 'c_custkey'), ('height', '150 + c_custkey % 40'), ('weight', '45 + c_custkey % 50'))},
       t + (c_custkey % 61) * 60000
FROM cu
UNION ALL
SELECT 'dim_coupon_use', id, 'c', {_img(('order_detail_id', 'id'), ('coupon_id', 'tax'))}, t
FROM dl WHERE tax >= 6
UNION ALL
SELECT 'dim_order_brief', id, op, {_img(('id', 'id'), ('order_status', 's'))}, t FROM oi
"""

ORACLE["upsert_latest"] = f"""
WITH {ORD},
v AS (
  SELECT id, '1001' AS order_status, t0 AS ts_ms, 0 AS r FROM o
  UNION ALL SELECT id, '1002', t0 + 600000, 1 FROM o WHERE st = 'F'
  UNION ALL SELECT id, '1003', t0 + 1800000, 1 FROM o WHERE st = 'P'
  UNION ALL SELECT id, '1005', t0 + 259200000, 2 FROM o WHERE st = 'F' AND prio = '1-URGENT'),
last AS (SELECT id, arg_max(order_status, ts_ms) AS order_status, max(ts_ms) AS ts_ms FROM v GROUP BY id)
SELECT last.* FROM last JOIN o USING (id) WHERE NOT (o.st = 'P' AND o.prio = '5-LOW')
"""

# ------------------------------------------------------------------- logs
ORACLE["log_etl"] = f"""
WITH {EV}
SELECT log_id, 'ok' AS status, 'mid_' || user_id AS mid,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'view' THEN 'home'
            WHEN event_type = 'click' THEN 'good_detail' ELSE event_type END AS page_id,
       ts, CAST(k % 2 AS VARCHAR) AS is_new,
       CASE WHEN event_type = 'view' THEN k % 4 ELSE 0 END AS n_displays,
       CASE WHEN event_type = 'click' THEN k % 3 ELSE 0 END AS n_actions,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS has_err,
       CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS has_start, NULL AS bad_length
FROM ev WHERE log_id % 50 <> 49
UNION ALL
SELECT log_id, 'bad', NULL, NULL, NULL, NULL, 0, 0, 0, 0, 20 FROM ev WHERE log_id % 50 = 49
"""

ORACLE["is_new_repair"] = f"""
WITH {EV},
f AS (
  SELECT user_id, arg_min(k % 2, (ts, log_id)) AS first_new, min(ts) AS first_ts
  FROM ev GROUP BY user_id),
a AS (
  SELECT user_id,
         CASE WHEN first_new = 1 THEN CAST(epoch_ms(first_ts) AS DATE)
              ELSE CAST(epoch_ms(first_ts) AS DATE) - 1 END AS anchor
  FROM f)
SELECT log_id, 'mid_' || ev.user_id AS mid, ts,
       CASE WHEN k % 2 = 1 AND CAST(epoch_ms(ts) AS DATE) <> anchor THEN '0'
            ELSE CAST(k % 2 AS VARCHAR) END AS is_new
FROM ev JOIN a USING (user_id)
"""

ORACLE["log_split_counts"] = f"""
WITH {EV}
SELECT 'err' AS stream, count(*) AS n_rows FROM ev WHERE event_type = 'error'
UNION ALL SELECT 'start', count(*) FROM ev WHERE event_type = 'signup'
UNION ALL SELECT 'display', coalesce(sum(k % 4), 0) FROM ev WHERE event_type = 'view'
UNION ALL SELECT 'action', coalesce(sum(k % 3), 0) FROM ev WHERE event_type = 'click'
UNION ALL SELECT 'page', count(*) FROM ev WHERE event_type <> 'signup'
"""

ORACLE["log_displays"] = f"""
WITH {EV}
SELECT log_id, 'mid_' || user_id AS mid, 'home' AS page_id, CAST(k + i AS VARCHAR) AS item,
       CAST(i AS VARCHAR) AS pos_id, ts
FROM ev, range(1, 4) AS r(i)
WHERE event_type = 'view' AND i <= k % 4
"""

ORACLE["log_actions"] = f"""
WITH {EV}
SELECT log_id, 'mid_' || user_id AS mid, 'good_detail' AS page_id,
       CASE WHEN i = 1 THEN 'cart_add' ELSE 'favor_add' END AS action_id,
       CAST(k + i AS VARCHAR) AS item, CAST(ts + i * 1000 AS VARCHAR) AS action_ts
FROM ev, range(1, 3) AS r(i)
WHERE event_type = 'click' AND i <= k % 3
"""

# ------------------------------------------------------------------ facts
ORACLE["dwd_cart_add"] = f"""
WITH {EV}
SELECT CAST(log_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
       CAST(k AS VARCHAR) AS sku_id, CAST(k % 5 + 1 AS VARCHAR) AS sku_num, ts AS ts_ms
FROM ev WHERE event_type = 'click'
UNION ALL
SELECT CAST(log_id AS VARCHAR), CAST(user_id AS VARCHAR), CAST(k AS VARCHAR),
       CAST(k % 3 - 1 AS VARCHAR), ts
FROM ev WHERE event_type = 'purchase' AND k % 3 >= 1
"""

ORACLE["dwd_order_detail"] = f"""
WITH {DETAIL_FACT}
SELECT * FROM od
"""

ORACLE["dwd_order_cancel"] = f"""
WITH {DETAIL_FACT}
SELECT od.id, od.order_id, od.user_id, od.sku_id, od.sku_name, od.province_id, od.activity_id,
       od.activity_rule_id, od.coupon_id,
       strftime(epoch_ms(o.t0 + 1800000), '%Y-%m-%d') AS order_cancel_date_id,
       {fmt('o.t0 + 1800000')} AS operate_time, od.sku_num, od.split_original_amount,
       od.split_activity_amount, od.split_coupon_amount, od.split_total_amount,
       o.t0 + 1800000 AS ts_ms
FROM od JOIN o ON od.order_id = o.id WHERE o.st = 'P'
"""

ORACLE["dwd_payment"] = f"""
WITH {DETAIL_FACT}, {DIC},
pi AS (SELECT id AS order_id, '110' || (o_orderkey % 3 + 1) AS ptype, t0 + 600000 AS t
       FROM o WHERE st = 'F')
SELECT od.id AS order_detail_id, od.order_id, od.user_id, od.sku_id, od.sku_name,
       od.province_id, od.activity_id, od.activity_rule_id, od.coupon_id,
       pi.ptype AS payment_type_code, dic.dic_name AS payment_type_name,
       {fmt('pi.t')} AS callback_time, od.sku_num, od.split_original_amount,
       od.split_activity_amount, od.split_coupon_amount, od.split_total_amount AS split_payment_amount,
       pi.t AS ts_ms
FROM pi JOIN od ON pi.order_id = od.order_id JOIN dic ON pi.ptype = dic.dic_code
"""

ORACLE["dwd_refund"] = f"""
WITH {ORD}, {DIC},
ri AS (SELECT *, t0 + 259200000 AS t, '150' || (o_orderkey % 2 + 1) AS rtype,
              '130' || (o_orderkey % 3 + 1) AS rreason
       FROM o WHERE st = 'F' AND prio = '1-URGENT')
SELECT ri.id, ri.user_id, ri.id AS order_id, CAST(o_orderkey % 2000 AS VARCHAR) AS sku_id,
       ri.province_id, strftime(epoch_ms(t), '%Y-%m-%d') AS date_id, {fmt('t')} AS create_time,
       rtype AS refund_type_code, d1.dic_name AS refund_type_name,
       rreason AS refund_reason_type_code, d2.dic_name AS refund_reason_type_name,
       'reason ' || o_orderkey AS refund_reason_txt, '1' AS refund_num,
       ri.total_amount AS refund_amount, t AS ts_ms
FROM ri JOIN dic d1 ON rtype = d1.dic_code JOIN dic d2 ON rreason = d2.dic_code
"""

ORACLE["dwd_comment"] = f"""
WITH {DIC}
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(doc_id % 1500 AS VARCHAR) AS user_id,
       CAST(doc_id % 2000 AS VARCHAR) AS sku_id, '120' || (doc_id % 4 + 1) AS appraise,
       dic.dic_name AS appraise_name, text AS comment_txt, 1704067200000 + doc_id * 900000 + 20000 + (doc_id % 50) * 1000 AS ts
FROM documents JOIN dic ON '120' || (doc_id % 4 + 1) = dic.dic_code
"""

ORACLE["lookup_join"] = f"""
WITH {DETAIL_FACT}
SELECT od.id, od.order_id, od.province_id, n.n_name AS province_name, od.sku_id,
       coalesce(p.p_name, 'N/A') AS dim_sku_name,
       coalesce(regexp_extract(p.p_brand, '#(\\d+)', 1), 'N/A') AS tm_id
FROM od LEFT JOIN nation n ON od.province_id = CAST(n.n_nationkey AS VARCHAR)
LEFT JOIN part p ON od.sku_id = CAST(p.p_partkey AS VARCHAR)
"""

# -------------------------------------------------------------------- DWS
ORACLE["dws_home_detail_uv"] = f"""
WITH {PAGES},
f AS (
  SELECT page_id, min(ts) AS ts FROM pages WHERE page_id IN ('home', 'good_detail')
  GROUP BY mid, page_id, {day('ts')})
SELECT {win('ts', 10000)},
       sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS home_uv_ct,
       sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS good_detail_uv_ct
FROM f GROUP BY ALL
"""

ORACLE["dws_cart_add_uu"] = f"""
WITH {EV},
c AS (SELECT user_id, ts FROM ev WHERE event_type = 'click'
      UNION ALL SELECT user_id, ts FROM ev WHERE event_type = 'purchase' AND k % 3 >= 1),
f AS (SELECT min(ts) AS ts FROM c GROUP BY user_id, {day('ts')})
SELECT {win('ts', 10000)}, count(*) AS cart_add_uu_ct FROM f GROUP BY ALL
"""

ORACLE["dws_user_login"] = f"""
WITH {PAGES},
f AS (SELECT uid, CAST(epoch_ms(ts) AS DATE) AS d, min(ts) AS ts FROM pages
      WHERE uid IS NOT NULL AND uid <> '' AND coalesce(last_page_id, '') IN ('', 'login')
      GROUP BY uid, d),
g AS (SELECT ts, lag(d) OVER (PARTITION BY uid ORDER BY d) AS pd FROM f)
SELECT {win('ts', 1000)},
       sum(CASE WHEN pd IS NOT NULL
                 AND (ts - epoch_us(CAST(pd AS TIMESTAMP)) // 1000) // 86400000 >= 8
                THEN 1 ELSE 0 END) AS back_ct,
       count(*) AS uu_ct
FROM g GROUP BY ALL
"""

RETRACTED = DETAIL_FACT + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, sku_id DESC, sku_num DESC,
      split_original_amount DESC, split_total_amount DESC, split_activity_amount DESC,
      split_coupon_amount DESC, activity_id DESC NULLS LAST, coupon_id DESC NULLS LAST,
      create_time DESC) AS rn
  FROM od)"""


def _d4(c: str) -> str:
    return f"CAST({c} AS DECIMAL(20,4))"


ORACLE["retract_dedup"] = f"""
WITH {RETRACTED}
SELECT id, 1 AS sign, sku_id, ts_ms, {_d4('split_original_amount')} AS split_original_amount,
       {_d4('split_activity_amount')} AS split_activity_amount,
       {_d4('split_coupon_amount')} AS split_coupon_amount,
       {_d4('split_total_amount')} AS split_total_amount
FROM ranked
UNION ALL
SELECT id, -1, sku_id, ts_ms, -{_d4('split_original_amount')}, -{_d4('split_activity_amount')},
       -{_d4('split_coupon_amount')}, -{_d4('split_total_amount')}
FROM ranked WHERE rn > 1
"""


ORACLE["dwd_order_detail_latest"] = f"""
WITH {RETRACTED}
SELECT id, order_id, user_id, sku_id, province_id, activity_id, coupon_id, sku_num,
       split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, ts_ms
FROM ranked WHERE rn = 1
"""


def _lastsum(c: str, alias: str) -> str:
    return f"sum(CASE WHEN rn = 1 THEN coalesce({_d4(c)}, 0) ELSE 0 END) AS {alias}"


ORACLE["dws_sku_order"] = f"""
WITH {RETRACTED},
agg AS (
  SELECT ts_ms - ts_ms % 10000 AS ws, sku_id,
         {_lastsum('split_original_amount', 'original_amount')},
         {_lastsum('split_activity_amount', 'activity_reduce_amount')},
         {_lastsum('split_coupon_amount', 'coupon_reduce_amount')},
         {_lastsum('split_total_amount', 'order_amount')}
  FROM ranked GROUP BY ALL),
p AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, p_brand, p_type, p_size,
             CAST(p_partkey % 200 AS VARCHAR) AS spu_id,
             regexp_extract(p_brand, '#(\\d+)', 1) AS tm_id,
             p_type || '_' || (p_size % 4) AS c3 FROM part)
SELECT {win('ws', 10000)}, agg.sku_id, original_amount, activity_reduce_amount,
       coupon_reduce_amount, order_amount,
       p.p_name AS sku_name, p.spu_id, p.tm_id AS trademark_id, p.c3 AS category3_id,
       CASE WHEN p.spu_id IS NOT NULL THEN 'spu_' || p.spu_id END AS spu_name,
       ['苹果','欧莱雅','香奈儿','Redmi','联想','长粒香','金沙河','小米','华为','耐克'][
         CAST(p.tm_id AS INTEGER) % 10 + 1] AS trademark_name,
       lower(p.p_type) || ' size ' || (p.p_size % 4) AS category3_name,
       p.p_type AS category2_id, lower(p.p_type) AS category2_name,
       substr(p.p_type, 1, 1) AS category1_id, 'group ' || substr(p.p_type, 1, 1) AS category1_name
FROM agg LEFT JOIN p ON agg.sku_id = p.id
"""

ORACLE["dws_province_order"] = f"""
WITH {RETRACTED},
agg AS (
  SELECT ts_ms - ts_ms % 1000 AS ws, province_id,
         count(DISTINCT order_id) AS order_count,
         {_lastsum('split_total_amount', 'order_amount')}
  FROM ranked GROUP BY ALL)
SELECT {win('ws', 1000)}, province_id, order_count, order_amount, n.n_name AS province_name
FROM agg LEFT JOIN nation n ON province_id = CAST(n.n_nationkey AS VARCHAR)
"""

TOKENS = """
list_concat(
  list_transform(regexp_extract_all(item, '[A-Za-z0-9]+'), lambda s: lower(s)),
  flatten(list_transform(regexp_extract_all(item, '[\\x{4E00}-\\x{9FFF}]+'),
    lambda r: CASE WHEN length(r) = 1 THEN [r]
              ELSE list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) END)))"""

ORACLE["dws_keyword_count"] = f"""
WITH {PAGES},
kw AS (SELECT ts, unnest({TOKENS}) AS keyword FROM pages
       WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL)
SELECT {win('ts', 1000)}, keyword, count(*) AS keyword_count FROM kw GROUP BY ALL
"""

# ------------------------------------------------------------------ label
def bday(c: str) -> str:
    return f"(DATE '1970-01-01' + CAST(3000 + ({c} * 37) % 15000 AS INTEGER))"


def age(b: str, t: str) -> str:
    return (f"(year({t}) - year({b}) - CASE WHEN month({t}) * 100 + day({t}) < "
            f"month({b}) * 100 + day({b}) THEN 1 ELSE 0 END)")


def zodiac(b: str) -> str:
    md = f"(month({b}) * 100 + day({b}))"
    cases = [(119, '摩羯座'), (218, '水瓶座'), (320, '双鱼座'), (419, '白羊座'), (520, '金牛座'),
             (621, '双子座'), (722, '巨蟹座'), (822, '狮子座'), (922, '处女座'), (1023, '天秤座'),
             (1122, '天蝎座'), (1221, '射手座')]
    return "CASE " + " ".join(f"WHEN {md} <= {d} THEN '{n}'" for d, n in cases) + " ELSE '摩羯座' END"


USERS = f"""
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS uname,
         CAST(c_custkey % 5 + 1 AS VARCHAR) AS user_level, 'login' || c_custkey AS login_name,
         '1380000' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS phone_num,
         'u' || c_custkey || '@example.com' AS email,
         CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'home' END AS gender,
         strftime({bday('c_custkey')}, '%Y-%m-%d') AS birthday,
         substr(strftime({bday('c_custkey')}, '%Y-%m-%d'), 1, 3) || '0' AS decade,
         {age(bday('c_custkey'), "DATE '2025-06-15'")} AS age,
         {zodiac(bday('c_custkey'))} AS zodiac_sign,
         1704067200000 + c_custkey * 60000 AS ts_ms
  FROM customer)"""

ORACLE["label_user_profile"] = f"WITH {USERS} SELECT * FROM users"

PROJ = PAGES + """,
proj AS (
  SELECT DISTINCT uid, ts, ar, ba, ch, md, split_part(os, ' ', 1) AS os, vc,
         CASE WHEN item_type = 'keyword' THEN item END AS search_item
  FROM pages)"""

ORACLE["label_log_projection"] = f"WITH {PROJ} SELECT * FROM proj"

ORDER_RECS = ORD + """,
orec AS (
  SELECT 'c' AS op, id AS order_id, total_amount, user_id AS uid, t0, t0 AS ts_ms FROM o
  UNION ALL SELECT 'u', id, total_amount, user_id, t0, t0 + 600000 FROM o WHERE st = 'F'
  UNION ALL SELECT 'u', id, total_amount, user_id, t0, t0 + 1800000 FROM o WHERE st = 'P'
  UNION ALL SELECT 'u', id, total_amount, user_id, t0, t0 + 259200000 FROM o
            WHERE st = 'F' AND prio = '1-URGENT')"""

ORACLE["label_order_projection"] = f"""
WITH {ORDER_RECS}
SELECT op, order_id, {fmt('t0')} AS create_time, total_amount, uid, ts_ms FROM orec
"""

ORACLE["label_detail_projection"] = f"""
WITH {LINES}
SELECT 'c' AS op, order_id, t AS ts_ms, sku_id, id AS detail_id FROM dl
"""

ORACLE["label_user_orders"] = f"""
WITH {ORDER_RECS}
SELECT uid, count(*) AS pv, min({fmt('t0')}) AS first_create_time,
       max({fmt('t0')}) AS last_create_time, count(DISTINCT order_id) AS n_orders,
       sum(CAST(total_amount AS DECIMAL(20,2))) AS total_amount_sum,
       min(ts_ms) AS first_ts_ms, max(ts_ms) AS last_ts_ms
FROM orec GROUP BY uid
"""


PROFILE = PROJ + """,
b AS (SELECT *, ts // 60000 AS w FROM proj),
wins AS (SELECT DISTINCT uid, w FROM b),
profile AS (
  SELECT wins.uid, wins.w * 60000 AS window_start_ms, count(*) AS pv, min(b.os) AS os,
         CAST(min(b.ts) AS VARCHAR) AS ts,
         arg_max(b.search_item, (b.ts, b.search_item)) FILTER (WHERE b.search_item IS NOT NULL) AS last_search
  FROM wins JOIN b ON b.uid = wins.uid AND b.w <= wins.w
  GROUP BY wins.uid, wins.w)"""

ORACLE["label_profile_values"] = f"""
WITH {PROJ},
v AS (
  SELECT uid, ts, unnest(['os', 'ch', 'md', 'ba', 'search_item']) AS field,
         unnest([os, ch, md, ba, search_item]) AS value FROM proj)
SELECT uid, field, value, min(ts // 60000) * 60000 AS first_window_ms
FROM v WHERE value IS NOT NULL GROUP BY uid, field, value
"""

ORACLE["label_order_values"] = f"""
WITH {ORDER_RECS}
SELECT DISTINCT uid, 'order_id' AS field, order_id AS value FROM orec
UNION ALL SELECT DISTINCT uid, 'create_time', {fmt('t0')} FROM orec
"""

ORACLE["label_user_activity"] = f"WITH {PROFILE} SELECT * FROM profile"

ORACLE["last_per_window"] = f"""
WITH {PAGES}
SELECT uid, (ts // 60000) * 60000 AS window_start_ms,
       arg_max(ts, (ts, log_id)) AS ts, arg_max(log_id, (ts, log_id)) AS log_id,
       arg_max(page_id, (ts, log_id)) AS page_id, arg_max(during_time, (ts, log_id)) AS during_time
FROM pages GROUP BY uid, ts // 60000
"""

HIER = """
hier AS (
  SELECT DISTINCT p_type || '_' || (p_size % 4) AS id,
         lower(p_type) || ' size ' || (p_size % 4) AS b3name, lower(p_type) AS b2name,
         'group ' || substr(p_type, 1, 1) AS b1name
  FROM part),
cmp(category_name, search_category) AS (VALUES ('group S', '时尚与潮流'), ('group P', '性价比'),
  ('group M', '健康与养生'), ('group L', '家庭与育儿'), ('group E', '科技与数码'))"""

ORACLE["category_hierarchy"] = f"WITH {HIER} SELECT id, b3name, b2name, b1name FROM hier"

MAPPING = HIER + """,
mapping AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, cmp.search_category AS bcname,
         ['苹果','欧莱雅','香奈儿','Redmi','联想','长粒香','金沙河','小米','华为','耐克'][
           CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) % 10 + 1] AS btname
  FROM part LEFT JOIN cmp ON cmp.category_name = 'group ' || substr(p_type, 1, 1))"""

ORACLE["sku_brand_category"] = f"WITH {MAPPING} SELECT * FROM mapping"


def _w(model: str, rows: list[tuple], match: str, coef: float, default=None) -> str:
    bands = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]
    vals = ", ".join("('" + r[0] + "', " + ", ".join(repr(x) for x in r[1:]) + ")" for r in rows)
    cols = ", ".join(f"w{i}" for i in range(6))
    sel = ", ".join(
        f"CAST(coalesce(round({model}_w.w{i} * {coef}, 3), {default[i] * coef if default else 0}) "
        f"AS DECIMAL(10,3)) AS {model}_{b}" for i, b in enumerate(bands))
    return sel, f"(VALUES {vals}) AS {model}_w(m, {cols})", match


DEVICE_ROWS = [("iOS", .7, .6, .5, .4, .3, .2), ("Android", .8, .7, .6, .5, .4, .3)]
SEARCH_ROWS = [("时尚与潮流", .9, .7, .5, .3, .2, .1), ("性价比", .2, .4, .6, .7, .8, .8),
               ("健康与养生", .1, .2, .4, .6, .8, .7), ("家庭与育儿", .1, .2, .4, .6, .8, .7),
               ("科技与数码", .8, .6, .4, .3, .2, .1), ("学习与发展", .4, .5, .6, .7, .8, .7)]
PRICE_ROWS = [("0-1000", .8, .6, .4, .3, .2, .1), ("1000-4000", .2, .4, .6, .7, .8, .7),
              ("other", .1, .2, .3, .4, .5, .6)]
BRAND_ROWS = [("苹果", .9, .7, .5, .3, .2, .1), ("欧莱雅", .2, .4, .6, .7, .8, .8),
              ("香奈儿", .2, .4, .6, .7, .8, .8), ("Redmi", .1, .2, .4, .6, .8, .7),
              ("联想", .1, .2, .4, .6, .8, .7), ("长粒香", .8, .6, .4, .3, .2, .1),
              ("金沙河", .8, .6, .4, .3, .2, .1)]
BRAND_DEFAULT = (.4, .5, .6, .7, .8, .7)

_dev_sel, _dev_tab, _ = _w("device", DEVICE_ROWS, "judge_os", 0.1)
_sea_sel, _sea_tab, _ = _w("search", SEARCH_ROWS, "search_category", 0.15)

LOG_SCORES_TAIL = f"""
ls0 AS (
  SELECT p.*, p.os AS judge_os, h.b1name AS b1_category,
         cmp.search_category
  FROM profile p
  LEFT JOIN (SELECT DISTINCT b3name, b1name FROM hier) h ON p.last_search = h.b3name
  LEFT JOIN cmp ON h.b1name = cmp.category_name),
log_scores AS (
  SELECT ls0.*, {_dev_sel}, {_sea_sel}
  FROM ls0 LEFT JOIN {_dev_tab} ON ls0.judge_os = device_w.m
  LEFT JOIN {_sea_tab} ON ls0.search_category = search_w.m)"""
LOG_SCORES = PROFILE + "," + HIER + "," + LOG_SCORES_TAIL

BANDS_ = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

ORACLE["label_search_category"] = f"""
WITH {LOG_SCORES}
SELECT uid, window_start_ms, last_search, b1_category, search_category FROM log_scores
"""

ORACLE["label_device_score"] = f"""
WITH {LOG_SCORES}
SELECT uid, window_start_ms, judge_os, {', '.join('device_' + b for b in BANDS_)} FROM log_scores
"""

ORACLE["label_search_score"] = f"""
WITH {LOG_SCORES}
SELECT uid, window_start_ms, search_category, {', '.join('search_' + b for b in BANDS_)}
FROM log_scores
"""

_pr_sel, _pr_tab, _ = _w("price", PRICE_ROWS, "price_bucket", 0.15)
_br_sel, _br_tab, _ = _w("brand", BRAND_ROWS, "btname", 0.2, BRAND_DEFAULT)
_ca_sel, _ca_tab, _ = _w("category", SEARCH_ROWS, "bcname", 0.3)

ORDER_SKUS = ORDER_RECS + "," + LINES + """,
oskus AS (
  SELECT orec.order_id, orec.ts_ms, orec.uid, orec.total_amount, orec.op,
         arg_min(dl.sku_id, (dl.t, dl.id, dl.sku_id)) AS sku_id,
         arg_min(dl.id, (dl.t, dl.id, dl.sku_id)) AS detail_id
  FROM orec JOIN dl ON dl.order_id = orec.order_id
       AND dl.t BETWEEN orec.ts_ms - 1800000 AND orec.ts_ms + 1800000
  GROUP BY ALL)"""

ORDER_SCORES = ORDER_SKUS + "," + MAPPING + f""",
os0 AS (
  SELECT oskus.*, mapping.btname, mapping.bcname,
         CASE WHEN CAST(total_amount AS DECIMAL(20,2)) BETWEEN 0 AND 1000 THEN '0-1000'
              WHEN CAST(total_amount AS DECIMAL(20,2)) > 1000
               AND CAST(total_amount AS DECIMAL(20,2)) <= 4000 THEN '1000-4000'
              ELSE 'other' END AS price_bucket
  FROM oskus LEFT JOIN mapping ON oskus.sku_id = mapping.id),
os1 AS (
  SELECT os0.*, {_pr_sel}, {_br_sel}, {_ca_sel}
  FROM os0 LEFT JOIN {_pr_tab} ON os0.price_bucket = price_w.m
  LEFT JOIN {_br_tab} ON os0.btname = brand_w.m
  LEFT JOIN {_ca_tab} ON os0.bcname = category_w.m),
order_scores AS (
  SELECT order_id, uid, sku_id, ts_ms, btname, bcname, price_bucket,
         {', '.join(f'CAST(brand_{b} + category_{b} + price_{b} AS DECIMAL(10,3)) AS sum_{b}'
                    for b in BANDS_)}
  FROM os1)"""

ORACLE["label_order_score"] = f"WITH {ORDER_SCORES} SELECT * FROM order_scores"

ORACLE["dedup_key"] = f"WITH {ORDER_SKUS} SELECT order_id, ts_ms, sku_id, detail_id FROM oskus"

_tot = ", ".join(f"CAST(os.sum_{b} + ll.search_{b} + ll.device_{b} AS DECIMAL(10,3)) AS total_{b}"
                 for b in BANDS_)
_labels = "['18-24','25-29','30-34','35-39','40-49','50以上']"
_arr = "[" + ", ".join(f"total_{b}" for b in BANDS_) + "]"

ORACLE["label_age_band"] = f"""
WITH {USERS}, {ORDER_SCORES}, {PROFILE}, {LOG_SCORES_TAIL},
pairs AS (
  SELECT users.*, order_id, greatest(users.ts_ms, s.ts_ms) AS event_ts_ms,
         {', '.join('s.sum_' + b for b in BANDS_)}
  FROM users JOIN order_scores s ON users.id = s.uid
   AND s.ts_ms BETWEEN users.ts_ms - 1800000 AND users.ts_ms + 1800000),
t AS (
  SELECT os.id, uname, gender, age, zodiac_sign, decade, order_id, event_ts_ms, ll.window_start_ms, {_tot}
  FROM pairs os JOIN log_scores ll ON os.id = ll.uid
   AND CAST(ll.ts AS BIGINT) BETWEEN event_ts_ms - 43200000 AND event_ts_ms + 43200000)
SELECT *, {_labels}[list_position({_arr}, list_max({_arr}))] AS max_age FROM t
"""

ORACLE["interval_join_30m"] = f"""
WITH {USERS}
SELECT users.*, CAST(150 + c_custkey % 40 AS VARCHAR) AS height, 'cm' AS unit_height,
       CAST(45 + c_custkey % 50 AS VARCHAR) AS weight, 'kg' AS unit_weight,
       users.ts_ms + (c_custkey % 61) * 60000 AS sup_ts_ms
FROM users JOIN customer ON users.id = CAST(c_custkey AS VARCHAR)
WHERE c_custkey % 61 <= 30
"""

ORACLE["interval_join_12h"] = f"""
WITH {USERS}, {LOG_SCORES.replace('WITH', '')}
SELECT users.id, users.ts_ms, CAST(l.ts AS BIGINT) AS log_ts, l.judge_os, l.search_category,
       {', '.join('l.device_' + b for b in BANDS_)}, {', '.join('l.search_' + b for b in BANDS_)}
FROM users JOIN log_scores l ON users.id = l.uid
 AND CAST(l.ts AS BIGINT) BETWEEN users.ts_ms - 43200000 AND users.ts_ms + 43200000
"""

ORACLE["dedup_exact"] = """
SELECT source, lang, md5(text) AS text_md5, length(text) AS n_chars
FROM (SELECT DISTINCT source, lang, text FROM documents)
"""

# ------------------------------------------------------------- moderation
COMMENTS = DIC + """,
cm AS (
  SELECT 1704067200000 + doc_id * 900000 + 20000 + (doc_id % 50) * 1000 AS ts_ms,
         '120' || (doc_id % 4 + 1) AS appraise, text AS comment_txt, doc_id AS id,
         doc_id % 1500 AS user_id, doc_id * 15 AS order_id, 'nick_' || (doc_id % 1500) AS nick_name
  FROM documents),
comments AS (
  SELECT cm.*, coalesce(dic.dic_name, 'N/A') AS dic_name
  FROM cm LEFT JOIN dic ON cm.appraise = dic.dic_code)"""

ORACLE["comment_dic_enrich"] = f"""
WITH {COMMENTS}
SELECT id, appraise, dic_name, user_id, order_id, nick_name, ts_ms FROM comments
"""

CO = COMMENTS + "," + ORD + """,
orecs AS (
  SELECT o_orderkey AS id, 'c' AS op, t0 AS tm_ms, '1001' AS st, 'consignee_' || o_custkey AS consignee
  FROM o
  UNION ALL SELECT o_orderkey, 'u', t0 + 600000, '1002', 'consignee_' || o_custkey FROM o WHERE st = 'F'
  UNION ALL SELECT o_orderkey, 'u', t0 + 1800000, '1003', 'consignee_' || o_custkey FROM o WHERE st = 'P'
  UNION ALL SELECT o_orderkey, 'u', t0 + 259200000, '1005', 'consignee_' || o_custkey FROM o
            WHERE st = 'F' AND prio = '1-URGENT'
  UNION ALL SELECT o_orderkey, 'd', t0 + 86400000, '1003', 'consignee_' || o_custkey FROM o
            WHERE st = 'P' AND prio = '5-LOW'),
co AS (
  SELECT comments.*, orecs.id AS info_id, orecs.op AS info_op, orecs.tm_ms AS info_tm_ms,
         orecs.st AS info_order_status, orecs.consignee AS info_consignee,
         strftime(epoch_ms(comments.ts_ms), '%Y%m%d') AS ds
  FROM comments JOIN orecs ON comments.order_id = orecs.id
   AND orecs.tm_ms BETWEEN comments.ts_ms - 60000 AND comments.ts_ms + 60000)"""

ORACLE["comment_order_join"] = f"""
WITH {CO}
SELECT id, order_id, ts_ms, info_id, info_op, info_tm_ms, info_order_status, info_consignee, ds
FROM co
"""

ORACLE["ds_partition"] = f"""
WITH {COMMENTS}
SELECT strftime(epoch_ms(ts_ms), '%Y%m%d') AS ds, count(*) AS n_rows FROM comments GROUP BY 1
"""

WORDS_SQL = "['idiot', 'stupid', 'hate', 'token', 'License']"


def last_tok(text: str, sep: str) -> str:
    return (f"coalesce(list_filter(string_split({text}, '{sep}'), lambda t: t <> '')[-1], '')")


ORACLE["word_membership"] = f"""
WITH {COMMENTS}
SELECT id, {last_tok('comment_txt', ' ')} AS last_word,
       list_contains({WORDS_SQL}, {last_tok('comment_txt', ' ')}) AS listed
FROM comments
"""

P0 = CO + f""",
p0 AS (
  SELECT user_id, info_consignee AS consignee, ts_ms, ds, comment_txt AS msg,
         {last_tok('comment_txt', ',')} AS lt
  FROM co
  QUALIFY row_number() OVER (PARTITION BY order_id, ts_ms
                             ORDER BY info_tm_ms, info_op, info_order_status, id) = 1),
p0f AS (
  SELECT user_id, consignee, ts_ms, ds, msg,
         CASE WHEN list_contains({WORDS_SQL}, lt) THEN 1 ELSE 0 END AS is_violation,
         CASE WHEN list_contains({WORDS_SQL}, lt) THEN 'P0' ELSE '' END AS violation_grade,
         CASE WHEN list_contains({WORDS_SQL}, lt) THEN lt ELSE '' END AS violation_msg
  FROM p0)"""

ORACLE["moderation_p0"] = f"WITH {P0} SELECT * FROM p0f"

ORACLE["moderation_p1"] = f"""
WITH {P0},
f AS (SELECT *, list_sort(list_filter({WORDS_SQL}, lambda w: contains(coalesce(msg, ''), w))) AS found
      FROM p0f)
SELECT user_id, consignee, ts_ms, ds, msg, is_violation,
       CASE WHEN is_violation = 0 AND len(found) > 0 THEN 'P1' ELSE violation_grade END AS violation_grade,
       CASE WHEN is_violation = 0 AND len(found) > 0 THEN array_to_string(found, ', ')
            ELSE violation_msg END AS violation_msg
FROM f
"""

# -------------------------------------------------------------- functions
ORACLE["fn_dates"] = f"""
WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events)
SELECT event_id, ts_ms, strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS d, {fmt('ts_ms')} AS dt,
       strftime(epoch_ms(ts_ms), '%Y%m%d') AS ds,
       (ts_ms // 1000) * 1000 - 28800000 AS ms_from_text_utc8,
       strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS date_from_text,
       strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS date_from_ms_text,
       (ts_ms - 1704067200000) // 86400000 AS days_since_base,
       strftime(epoch_ms(ts_ms), '%Y-%m-%d') AS epoch_day_date,
       {win('ts_ms', 3600000)}
FROM e
"""

ORACLE["fn_age_zodiac"] = f"""
SELECT c_custkey, strftime({bday('c_custkey')}, '%Y-%m-%d') AS birthday,
       substr(strftime({bday('c_custkey')}, '%Y-%m-%d'), 1, 3) || '0' AS decade,
       {age(bday('c_custkey'), "DATE '2024-02-29'")} AS age_leap,
       {age(bday('c_custkey'), "DATE '2025-06-15'")} AS age_today,
       {zodiac(bday('c_custkey'))} AS zodiac_sign
FROM customer
"""

ORACLE["fn_text_json"] = f"""
SELECT doc_id, md5(text) AS text_md5, length({last_tok('text', ',')}) AS last_comma_len,
       string_split(text, ' ')[1] AS first_word, lang AS json_lang,
       CASE WHEN coalesce(source, '') = '' THEN 1 ELSE 0 END AS source_empty,
       len(list_concat(regexp_extract_all(text, '[A-Za-z0-9]+'),
         flatten(list_transform(regexp_extract_all(text, '[\\x{{4E00}}-\\x{{9FFF}}]+'),
           lambda r: CASE WHEN length(r) = 1 THEN [r]
                          ELSE list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) END))))
         AS n_tokens
FROM documents
"""

ORACLE["run_summary"] = """
WITH e AS (SELECT epoch_us(ts) // 1000 AS ts_ms, event_type <> 'error' AS ok,
                  CAST(CAST(ts AS DATE) AS VARCHAR) AS run_day FROM events)
SELECT run_day, sum(CAST(ok AS INTEGER)) AS n_success, sum(CAST(NOT ok AS INTEGER)) AS n_fail,
       min(ts_ms) AS start_ms, max(ts_ms) AS end_ms, (max(ts_ms) - min(ts_ms)) // 1000 AS duration_s
FROM e GROUP BY run_day
"""

ORACLE["run_failed_ids"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_day, event_id AS failed_id
FROM events WHERE event_type = 'error'
"""

# The SQL forms of these jobs give the same rows.
for _name, _same in (("dwd_cart_add_sql", "dwd_cart_add"), ("dwd_comment_sql", "dwd_comment"),
                     ("dwd_refund_sql", "dwd_refund"), ("dws_keyword_sql", "dws_keyword_count")):
    ORACLE[_name] = ORACLE[_same]
