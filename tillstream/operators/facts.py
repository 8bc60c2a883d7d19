"""DWD fact tables from change records (PRJ-5 … PRJ-11, JN-1 … JN-7).

All are projections and equi-joins, so Catalyst pushes the table/op filters
below the joins and prunes the maps to the keys read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.dates import text_to_date
from tillstream.operators.cdc import latest_per_key, table_changes
from tillstream.operators.joins import lookup



class _Image:
    """``A["k"]`` → ``after['k']`` (built lazily; columns need a live session)."""

    def __init__(self, name: str):
        self.name = name

    def __getitem__(self, key: str):
        return F.col(self.name)[key]


A = _Image("after")
B = _Image("before")


def _src_ts():
    return F.col("source")["ts_ms"].try_cast("bigint").alias("ts_ms")


def cart_add(changes: DataFrame) -> DataFrame:
    """PRJ-5: inserts, and updates that raise (or keep) the quantity; an
    update carries the increase."""
    c = table_changes(changes, "cart_info")
    up = (F.col("op") == "u") & B["sku_num"].isNotNull() & \
        (A["sku_num"].try_cast("int") >= B["sku_num"].try_cast("int"))
    c = c.where((F.col("op") == "c") | up)
    return c.select(
        A["id"].alias("id"), A["user_id"].alias("user_id"), A["sku_id"].alias("sku_id"),
        F.when(F.col("op") == "c", A["sku_num"]).otherwise(
            (A["sku_num"].try_cast("int") - B["sku_num"].try_cast("int")).cast("string")).alias("sku_num"),
        _src_ts())


def _as_number(c: str) -> list:
    """An amount's text ``c`` as a number, and the text itself only where it is
    not the number's own: amounts cross the shuffles in 8 bytes."""
    n = A[c].try_cast("decimal(16,2)")
    return [n.alias(f"{c}_n"), F.when(~n.cast("string").eqNullSafe(A[c]), A[c]).alias(f"{c}_t")]


def _as_text(c: str):
    """The text that ``_as_number`` was given."""
    return F.coalesce(F.col(f"{c}_t"), F.col(f"{c}_n").cast("string")).alias(c)


def placed_orders(changes: DataFrame) -> DataFrame:
    """Inserted orders: what an order line takes from its order."""
    return table_changes(changes, "order_info", ["c"]).select(
        A["id"].alias("oi_id"), A["user_id"].alias("user_id"), A["province_id"].alias("province_id"))


def order_detail(changes: DataFrame, links: bool = True, orders: DataFrame | None = None) -> DataFrame:
    """PRJ-9/PRJ-10 + JN-1/JN-2: order lines ⨝ orders, ⟕ activity, ⟕ coupon.

    A line meets every activity and coupon row of its detail id, as a stream of
    joins does; the keyed sink keeps one row per id (``latest_details``).
    ``links=False`` leaves those two joins out, for aggregates that keep each
    id's latest row and read neither.  ``orders`` are ``placed_orders`` that were
    joined to an event of theirs; its columns are passed on, and only the lines
    of these orders go on to the joins by detail id.

    Lines and orders grow together, so they are merged by order id at any size."""
    od = table_changes(changes, "order_detail", ["c"]).select(
        A["id"].alias("id"), A["order_id"].alias("order_id"), A["sku_id"].alias("sku_id"),
        A["sku_name"].alias("sku_name"), A["create_time"].alias("create_time"),
        A["sku_num"].alias("sku_num"),
        A["order_price"].try_cast("decimal(16,2)").alias("order_price"),
        *_as_number("split_total_amount"), *_as_number("split_activity_amount"),
        *_as_number("split_coupon_amount"), _src_ts())
    oi = placed_orders(changes) if orders is None else orders
    event = [c for c in oi.columns if c not in ("oi_id", "user_id", "province_id")]
    act = table_changes(changes, "order_detail_activity", ["c"]).select(
        A["order_detail_id"].alias("act_id"), A["activity_id"].alias("activity_id"),
        A["activity_rule_id"].alias("activity_rule_id"))
    cou = table_changes(changes, "order_detail_coupon", ["c"]).select(
        A["order_detail_id"].alias("cou_id"), A["coupon_id"].alias("coupon_id"))
    j = od.join(oi.hint("merge"), od["order_id"] == oi["oi_id"], "inner")
    if links:
        j = (j.join(act, od["id"] == act["act_id"], "left")
              .join(cou, od["id"] == cou["cou_id"], "left"))
    else:
        none = F.lit(None).cast("string")
        j = j.select("*", none.alias("activity_id"), none.alias("activity_rule_id"), none.alias("coupon_id"))
    return j.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", text_to_date(F.col("create_time")).alias("date_id"),
        "create_time", "sku_num",
        (F.col("sku_num").try_cast("decimal(16,2)") * F.col("order_price")).cast("string")
         .alias("split_original_amount"),
        _as_text("split_activity_amount"), _as_text("split_coupon_amount"), _as_text("split_total_amount"),
        "ts_ms", *event)


def latest_details(details: DataFrame, order: list[str]) -> DataFrame:
    """SNK-4 on ``id``: the one row per detail id that the keyed sink ends with."""
    return latest_per_key(details, ["id"], order)


def cancelled_orders(changes: DataFrame) -> DataFrame:
    """Orders moved from 1001 to 1003."""
    return table_changes(changes, "order_info", ["u"]).where(
        (B["order_status"] == "1001") & (A["order_status"] == "1003")).select(
        A["id"].alias("oc_id"), A["operate_time"].alias("operate_time"),
        _src_ts().alias("oc_ts_ms"))


def cancel_columns() -> list:
    """The cancellation fact's columns, over order lines ⨝ cancelled orders."""
    return ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
            "activity_rule_id", "coupon_id",
            text_to_date(F.col("operate_time")).alias("order_cancel_date_id"), "operate_time",
            "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount",
            "split_total_amount", F.col("oc_ts_ms").alias("ts_ms")]


def order_cancel(changes: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """PRJ-6 + JN-3: order lines of cancelled orders.  Without given ``details``
    the cancellations meet their orders first, then the lines (all are inner
    joins on the order id): lines of other orders move once, not three times."""
    oc = cancelled_orders(changes)
    if details is None:
        oi = placed_orders(changes)
        return order_detail(changes, orders=oi.join(oc, oi["oi_id"] == oc["oc_id"], "inner")) \
            .select(*cancel_columns())
    return details.join(oc, details["order_id"] == oc["oc_id"], "inner").select(*cancel_columns())


def paid_orders(changes: DataFrame) -> DataFrame:
    """Payments that became successful."""
    return table_changes(changes, "payment_info", ["u"]).where(
        B["payment_status"].isNotNull() & (A["payment_status"] == "1602")).select(
        A["user_id"].alias("pi_user_id"), A["order_id"].alias("pi_order_id"),
        A["payment_type"].alias("payment_type_code"), A["callback_time"].alias("callback_time"),
        _src_ts().alias("pi_ts_ms"))


def payment_names(joined: DataFrame, dic: DataFrame) -> DataFrame:
    """The payment fact's columns, over payments ⨝ order lines."""
    j = lookup(joined, dic, [("payment_type_code", "dic_code")], {"dic_name": "payment_type_name"},
               how="inner")
    return j.select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name",
        "province_id", "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
        "payment_type_name", "callback_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"), F.col("pi_ts_ms").alias("ts_ms"))


def payment_success(changes: DataFrame, details: DataFrame | None, dic: DataFrame,
                    interval: tuple[int, int] | None = None) -> DataFrame:
    """PRJ-7 + JN-4 + JN-6: successful payments ⨝ order lines ⨝ payment-type
    names.  ``interval=(lo_ms, hi_ms)`` optionally bounds line time against the
    payment time (the reference's commented-out −30 min … +5 s).  Without given
    ``details`` the payments meet their orders first, as in ``order_cancel``."""
    pi = paid_orders(changes)
    if details is None:
        oi = placed_orders(changes)
        j = order_detail(changes, orders=oi.join(pi, oi["oi_id"] == pi["pi_order_id"], "inner"))
    else:
        j = pi.join(details, pi["pi_order_id"] == details["order_id"], "inner")
    if interval is not None:
        j = j.where(F.col("ts_ms").between(F.col("pi_ts_ms") + interval[0], F.col("pi_ts_ms") + interval[1]))
    return payment_names(j, dic)


def refund_requests(changes: DataFrame) -> DataFrame:
    return table_changes(changes, "order_refund_info", ["c"]).select(
        *[A[c].alias(c) for c in ["id", "user_id", "order_id", "sku_id", "refund_type",
                                  "refund_num", "refund_amount", "refund_reason_type",
                                  "refund_reason_txt", "create_time"]], _src_ts())


def refunding_orders(changes: DataFrame) -> DataFrame:
    """Orders that entered status 1005."""
    return table_changes(changes, "order_info", ["u"]).where(
        B["order_status"].isNotNull() & (A["order_status"] == "1005")).select(
        A["id"].alias("oi_id"), A["province_id"].alias("province_id"), _src_ts().alias("oi_ts_ms"))


def refund_names(joined: DataFrame, dic: DataFrame) -> DataFrame:
    """The refund fact's columns, over requests ⨝ orders."""
    j = lookup(joined, dic, [("refund_type", "dic_code")], {"dic_name": "refund_type_name"}, how="inner")
    j = lookup(j, dic, [("refund_reason_type", "dic_code")], {"dic_name": "refund_reason_type_name"},
               how="inner")
    return j.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        text_to_date(F.col("create_time")).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name",
        F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts_ms")


def refund(changes: DataFrame, dic: DataFrame) -> DataFrame:
    """PRJ-8 + JN-5 + JN-6 (twice): refund requests ⨝ orders in status 1005,
    with refund type and reason names."""
    ri, oi = refund_requests(changes), refunding_orders(changes)
    return refund_names(ri.join(oi, ri["order_id"] == oi["oi_id"], "inner"), dic)


def posted_comments(changes: DataFrame) -> DataFrame:
    """Comment rows; the source time lands in column ``ts`` as in the published
    topic."""
    return table_changes(changes, "comment_info").select(
        A["id"].alias("id"), A["user_id"].alias("user_id"), A["sku_id"].alias("sku_id"),
        A["appraise"].alias("appraise"), A["comment_txt"].alias("comment_txt"),
        _src_ts().alias("ts"))


def comment_names(comments: DataFrame, dic: DataFrame) -> DataFrame:
    """The comment fact's columns, with the appraisal name (inner lookup)."""
    j = lookup(comments, dic, [("appraise", "dic_code")], {"dic_name": "appraise_name"}, how="inner")
    return j.select("id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts")


def comment_fact(changes: DataFrame, dic: DataFrame) -> DataFrame:
    """PRJ-11 + JN-6: comments with the appraisal name."""
    return comment_names(posted_comments(changes), dic)
