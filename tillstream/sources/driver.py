"""Adapters from the driver's parquet tables to the warehouse's inputs.

Every adapter is row-local (a projection of one table, or a union of
projections), so it adds no shuffle and scales with the scan.  The same rules
are mirrored in DuckDB SQL by ``tillstream.plans.oracle``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.dates import ntz_millis
from tillstream.session import SPREAD_SCANS

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values for the synthetic click log built from `events`.
CHANNELS = ["xiaomi", "oppo", "vivo", "huawei", "web"]
BRANDS = ["Apple", "Xiaomi", "Huawei", "Oppo"]
SEARCH_WORDS = ["小米手机", "5G phone", "small size 1", "red widget",
                "运动鞋 跑步", "economy size 2", "笔记本电脑", "large size 3"]
# Change-stream clock: order k is placed at BASE_MS + k minutes; its lines a few
# seconds later and comments on it 20-69 s later, so interval joins see
# realistic gaps.  Users and their supplements follow the same rule.
BASE_MS = 1_704_067_200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table.  Where the deployment says that its files are few
    large row groups (``spark.tillstream.spreadScans``), the rows are dealt by a
    hash of the key column; AQE decides on the number of partitions."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spark.conf.get(SPREAD_SCANS, "false") == "true":
        return df.repartition(F.xxhash64(df.columns[0]))
    return df


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


# --------------------------------------------------------------------- logs
def events_log(events: DataFrame) -> DataFrame:
    """`events` → parsed application log (schema ``schemas.LOG``).

    signup → start log; every other event → page log.  view → page ``home``
    with ``k % 4`` displays; click → ``good_detail`` with ``k % 3`` actions;
    error → page log carrying an ``err`` object.
    """
    k = F.col("k")
    uid = F.col("user_id")
    et = F.col("event_type")
    common = F.struct(
        (k % 7).cast("string").alias("ar"),
        _pick(BRANDS, uid % 4).alias("ba"),
        _pick(CHANNELS, k % 5).alias("ch"),
        (k % 2).cast("string").alias("is_new"),
        F.concat(F.lit("md_"), uid % 7).alias("md"),
        F.concat(F.lit("mid_"), uid).alias("mid"),
        F.when(uid % 3 == 0, F.concat(F.lit("iOS 1"), k % 3 + 5, F.lit(".0")))
         .otherwise(F.concat(F.lit("Android 1"), k % 4, F.lit(".0"))).alias("os"),
        F.concat(F.lit("sid_"), uid).alias("sid"),
        uid.cast("string").alias("uid"),
        F.concat(F.lit("v2.1."), k % 3).alias("vc"),
    )
    keyword = (k % 4) == 2
    page = F.when(et != "signup", F.struct(
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        F.when(keyword, _pick(SEARCH_WORDS, k % 8)).otherwise(k.cast("string")).alias("item"),
        F.when(keyword, F.lit("keyword")).otherwise(F.lit("sku_id")).alias("item_type"),
        F.when(k % 8 == 5, F.lit("login")).when(k % 4 == 1, F.lit("home")).when(k % 4 == 2, F.lit("search"))
         .when(k % 4 == 3, F.lit("good_detail")).alias("last_page_id"),
        F.when(et == "view", F.lit("home")).when(et == "click", F.lit("good_detail"))
         .otherwise(et).alias("page_id"),
    ))
    start = F.when(et == "signup", F.create_map(
        F.lit("entry"), F.lit("icon"), F.lit("loading_time"), (k * 10).cast("string")))
    err = F.when(et == "error", F.create_map(
        F.lit("error_code"), (k + 1000).cast("string"), F.lit("msg"), F.concat(F.lit("E"), k)))
    displays = F.when((et == "view") & (k % 4 > 0), F.transform(
        F.sequence(F.lit(1), k % 4), lambda i: F.create_map(
            F.lit("item"), (k + i).cast("string"), F.lit("item_type"), F.lit("sku_id"),
            F.lit("pos_id"), i.cast("string"))))
    actions = F.when((et == "click") & (k % 3 > 0), F.transform(
        F.sequence(F.lit(1), k % 3), lambda i: F.create_map(
            F.lit("action_id"), F.when(i == 1, F.lit("cart_add")).otherwise(F.lit("favor_add")),
            F.lit("item"), (k + i).cast("string"),
            F.lit("ts"), (F.col("ts_ms") + i * 1000).cast("string"))))
    return (events
            .select("event_id", "user_id", "event_type", "value",
                    _k().alias("k"), ntz_millis("ts").alias("ts_ms"))
            .select(common.alias("common"), page.alias("page"), start.alias("start"),
                    err.alias("err"), displays.alias("displays"), actions.alias("actions"),
                    F.col("ts_ms").alias("ts"), F.col("event_id").alias("log_id")))


def events_log_text(events: DataFrame) -> DataFrame:
    """The same log as JSON text (one message per event).  Every 50th event id
    is cut to 20 characters to model a corrupt message."""
    log = events_log(events)
    js = F.to_json(F.struct("common", "page", "start", "err", "displays", "actions", "ts"))
    return log.select(
        "log_id",
        F.when(F.col("log_id") % 50 == 49, F.substring(js, 1, 20)).otherwise(js).alias("value"))


# --------------------------------------------------------------------- CDC
@dataclass
class _Change:
    """A change record that a row of a driver table stands for."""
    table: str
    op: str
    before: Column | None
    after: Column | None
    ts_ms: Column
    when: Column | None = None

    def fields(self) -> list[Column]:
        none = F.lit(None).cast("map<string,string>")
        return [
            (none if self.before is None else self.before).alias("before"),
            (none if self.after is None else self.after).alias("after"),
            F.create_map(F.lit("db"), F.lit("shop"), F.lit("table"), F.lit(self.table),
                         F.lit("ts_ms"), self.ts_ms.cast("string")).alias("source"),
            F.lit(self.op).alias("op"), self.ts_ms.alias("ts_ms")]


def _emit(rows: DataFrame, *changes: _Change) -> DataFrame:
    """Every change record of every row, from one scan of the rows."""
    records = [F.struct(*c.fields()) if c.when is None else F.when(c.when, F.struct(*c.fields()))
               for c in changes]
    return rows.select(F.explode(F.array(*records)).alias("c")).where(F.col("c").isNotNull()).select("c.*")


def _branches(rows: DataFrame, *changes: _Change) -> DataFrame:
    """The same records as a union of projections: a filter on the source table
    or op removes whole branches, and map keys nobody reads are never built."""
    out = None
    for c in changes:
        part = (rows if c.when is None else rows.where(c.when)).select(*c.fields())
        out = part if out is None else out.unionByName(part)
    return out


def _cents(x: Column) -> Column:
    """Whole cents of a 2-decimal money double (exact: the value is never near a half cent)."""
    return F.round(x * 100).cast("bigint")


def _idiv_half_up(a: Column, b: Column | int) -> Column:
    """Integer ``a / b`` rounded half up, for non-negative ``a`` and positive ``b``."""
    b = F.lit(b) if isinstance(b, int) else b
    return F.floor((a + F.floor(b / 2)) / b).cast("bigint")


def _money_text(cents: Column) -> Column:
    """Cents → ``123.45`` text (integer arithmetic only)."""
    return F.concat(F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def _dec_text(x: Column, scale: int = 2) -> Column:
    return _money_text(_cents(x))


def _ms_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


def _order_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey"), F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        (F.col("o_custkey") % 25).cast("string").alias("province_id"),
        _dec_text(F.col("o_totalprice")).alias("total_amount"),
        F.concat(F.lit("consignee_"), F.col("o_custkey")).alias("consignee"),
        F.concat(F.lit("order "), F.col("o_orderkey"), F.lit(" "), F.col("o_orderpriority"))
         .alias("trade_body"),
        F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("prio"),
        (F.lit(BASE_MS) + F.col("o_orderkey") * 60_000).alias("t0"))


def _order_info() -> list[_Change]:
    def img(status: str, operate: Column | None) -> Column:
        return F.create_map(
            F.lit("id"), F.col("id"), F.lit("user_id"), F.col("user_id"),
            F.lit("province_id"), F.col("province_id"), F.lit("order_status"), F.lit(status),
            F.lit("total_amount"), F.col("total_amount"),
            F.lit("create_time"), _ms_text(F.col("t0")),
            F.lit("operate_time"), operate if operate is not None else F.lit(None).cast("string"),
            F.lit("consignee"), F.col("consignee"), F.lit("trade_body"), F.col("trade_body"))

    def before(status: str) -> Column:
        return F.create_map(F.lit("id"), F.col("id"), F.lit("order_status"), F.lit(status))

    paid, cancelled = F.col("st") == "F", F.col("st") == "P"
    t_pay, t_cancel = F.col("t0") + 600_000, F.col("t0") + 1_800_000
    t_del, t_refund = F.col("t0") + 86_400_000, F.col("t0") + 3 * 86_400_000
    return [
        _Change("order_info", "c", None, img("1001", None), F.col("t0")),
        _Change("order_info", "u", before("1001"), img("1002", _ms_text(t_pay)), t_pay, paid),
        _Change("order_info", "u", before("1001"), img("1003", _ms_text(t_cancel)), t_cancel, cancelled),
        _Change("order_info", "u", before("1002"), img("1005", _ms_text(t_refund)), t_refund,
                paid & (F.col("prio") == "1-URGENT")),
        _Change("order_info", "d", img("1003", _ms_text(t_cancel)), None, t_del,
                cancelled & (F.col("prio") == "5-LOW")),
    ]


def order_changes(orders: DataFrame) -> DataFrame:
    """`orders` → ``order_info`` change records.

    Every order is inserted with status 1001 at ``BASE_MS + key minutes``.
    Status F orders are then paid (1001→1002, +10 min); status P orders are
    cancelled (1001→1003, +30 min); F orders of priority ``1-URGENT`` later ask
    for a refund (1002→1005, +3 days); cancelled ``5-LOW`` orders are deleted
    a day later.
    """
    return _branches(_order_rows(orders), *_order_info())


def order_info_changes(orders: DataFrame) -> DataFrame:
    """The same records from one scan, for jobs that read (nearly) all of them."""
    return _emit(_order_rows(orders), *_order_info())


def _payment_info() -> list[_Change]:
    """Status F orders → ``payment_info`` update 1601→1602 at +10 min."""
    t = F.col("t0") + 600_000
    after = F.create_map(
        F.lit("id"), F.col("id"), F.lit("user_id"), F.col("user_id"),
        F.lit("order_id"), F.col("id"),
        F.lit("payment_type"), F.concat(F.lit("110"), F.col("o_orderkey") % 3 + 1),
        F.lit("payment_status"), F.lit("1602"), F.lit("callback_time"), _ms_text(t))
    before = F.create_map(F.lit("id"), F.col("id"), F.lit("payment_status"), F.lit("1601"))
    return [_Change("payment_info", "u", before, after, t, F.col("st") == "F")]


def _refund_info() -> list[_Change]:
    """Refund requests: one ``order_refund_info`` insert per F / 1-URGENT order."""
    t = F.col("t0") + 3 * 86_400_000
    after = F.create_map(
        F.lit("id"), F.col("id"), F.lit("user_id"), F.col("user_id"), F.lit("order_id"), F.col("id"),
        F.lit("sku_id"), (F.col("o_orderkey") % 2000).cast("string"),
        F.lit("refund_type"), F.concat(F.lit("150"), F.col("o_orderkey") % 2 + 1),
        F.lit("refund_num"), F.lit("1"), F.lit("refund_amount"), F.col("total_amount"),
        F.lit("refund_reason_type"), F.concat(F.lit("130"), F.col("o_orderkey") % 3 + 1),
        F.lit("refund_reason_txt"), F.concat(F.lit("reason "), F.col("o_orderkey")),
        F.lit("create_time"), _ms_text(t))
    return [_Change("order_refund_info", "c", None, after, t,
                    (F.col("st") == "F") & (F.col("prio") == "1-URGENT"))]


def order_table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_info``, ``payment_info`` and ``order_refund_info`` records from
    one scan of `orders`."""
    return _emit(_order_rows(table(spark, sf_dir, "orders")), *_order_info(), *_payment_info(), *_refund_info())


def _line_changes(lineitem: DataFrame, emit) -> DataFrame:
    """`lineitem` → ``order_detail`` inserts plus activity / coupon links.

    The detail id is ``orderkey_linenumber``; the driver's table repeats some
    pairs, which the retraction and upsert operators must absorb.
    """
    ep = _cents(F.col("l_extendedprice"))
    disc = F.round(F.col("l_discount") * 100).cast("bigint")
    tax = F.round(F.col("l_tax") * 100).cast("bigint")
    qty = F.col("l_quantity").cast("bigint")
    li = lineitem.select(
        F.concat_ws("_", F.col("l_orderkey"), F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.concat(F.lit("sku_"), F.col("l_partkey")).alias("sku_name"),
        qty.cast("string").alias("sku_num"),
        _money_text(_idiv_half_up(ep, qty)).alias("order_price"),
        _money_text(_idiv_half_up(ep * (100 - disc), 100)).alias("split_total_amount"),
        _money_text(_idiv_half_up(ep * disc, 100)).alias("split_activity_amount"),
        _money_text(_idiv_half_up(ep * tax, 100)).alias("split_coupon_amount"),
        disc.cast("int").alias("disc"), tax.cast("int").alias("tax"),
        (F.lit(BASE_MS) + F.col("l_orderkey") * 60_000 + F.col("l_linenumber") * 1000).alias("t"))
    return emit(
        li,
        _Change("order_detail", "c", None, F.create_map(
            F.lit("id"), F.col("id"), F.lit("order_id"), F.col("order_id"),
            F.lit("sku_id"), F.col("sku_id"), F.lit("sku_name"), F.col("sku_name"),
            F.lit("create_time"), _ms_text(F.col("t")), F.lit("source_id"), F.lit(None).cast("string"),
            F.lit("source_type"), F.lit("2401"), F.lit("sku_num"), F.col("sku_num"),
            F.lit("order_price"), F.col("order_price"),
            F.lit("split_total_amount"), F.col("split_total_amount"),
            F.lit("split_activity_amount"), F.col("split_activity_amount"),
            F.lit("split_coupon_amount"), F.col("split_coupon_amount")), F.col("t")),
        _Change("order_detail_activity", "c", None, F.create_map(
            F.lit("order_detail_id"), F.col("id"),
            F.lit("activity_id"), F.col("disc").cast("string"),
            F.lit("activity_rule_id"), (F.col("disc") * 10).cast("string")), F.col("t"), F.col("disc") >= 5),
        _Change("order_detail_coupon", "c", None, F.create_map(
            F.lit("order_detail_id"), F.col("id"),
            F.lit("coupon_id"), F.col("tax").cast("string")), F.col("t"), F.col("tax") >= 6))


def detail_changes(lineitem: DataFrame) -> DataFrame:
    """``order_detail`` records and their activity / coupon links."""
    return _line_changes(lineitem, _branches)


def _cart_changes(events: DataFrame, emit) -> DataFrame:
    """`events` → ``cart_info`` records: click inserts ``k%5+1`` items; purchase
    updates from ``k%5+1`` to ``k%5+1 + (k%3 - 1)`` (up, equal or down);
    error updates without an old quantity."""
    e = events.select("event_id", "user_id", "event_type", _k().alias("k"),
                      ntz_millis("ts").alias("t"))
    base = (F.col("k") % 5 + 1)
    after = lambda n: F.create_map(
        F.lit("id"), F.col("event_id").cast("string"), F.lit("user_id"), F.col("user_id").cast("string"),
        F.lit("sku_id"), F.col("k").cast("string"), F.lit("sku_num"), n.cast("string"))
    kind = F.col("event_type")
    return emit(
        e,
        _Change("cart_info", "c", None, after(base), F.col("t"), kind == "click"),
        _Change("cart_info", "u", F.create_map(F.lit("id"), F.col("event_id").cast("string"),
                                               F.lit("sku_num"), base.cast("string")),
                after(base + F.col("k") % 3 - 1), F.col("t"), kind == "purchase"),
        _Change("cart_info", "u", F.create_map(F.lit("id"), F.col("event_id").cast("string")),
                after(base), F.col("t"), kind == "error"))


def cart_changes(events: DataFrame) -> DataFrame:
    """``cart_info`` records."""
    return _cart_changes(events, _branches)


def comment_changes(documents: DataFrame) -> DataFrame:
    """`documents` → ``comment_info`` inserts (one comment per document)."""
    d = documents.select(
        "doc_id", "text",
        (F.lit(BASE_MS) + F.col("doc_id") * 15 * 60_000 + 20_000 + (F.col("doc_id") % 50) * 1000)
        .alias("t"))
    after = F.create_map(
        F.lit("id"), F.col("doc_id").cast("string"),
        F.lit("user_id"), (F.col("doc_id") % 1500).cast("string"),
        F.lit("nick_name"), F.concat(F.lit("nick_"), F.col("doc_id") % 1500),
        F.lit("sku_id"), (F.col("doc_id") % 2000).cast("string"),
        F.lit("spu_id"), (F.col("doc_id") % 200).cast("string"),
        F.lit("order_id"), (F.col("doc_id") * 15).cast("string"),
        F.lit("appraise"), F.concat(F.lit("120"), F.col("doc_id") % 4 + 1),
        F.lit("comment_txt"), F.col("text"),
        F.lit("create_time"), _ms_text(F.col("t")))
    return _branches(d, _Change("comment_info", "c", None, after, F.col("t")))


def _user_rows(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", "c_name", (F.lit(BASE_MS) + F.col("c_custkey") * 60_000).alias("t"))


def _user_info() -> _Change:
    return _Change("user_info", "c", None, F.create_map(
        F.lit("id"), F.col("c_custkey").cast("string"),
        F.lit("name"), F.col("c_name"),
        F.lit("user_level"), (F.col("c_custkey") % 5 + 1).cast("string"),
        F.lit("login_name"), F.concat(F.lit("login"), F.col("c_custkey")),
        F.lit("phone_num"), F.concat(F.lit("1380000"), F.lpad(F.col("c_custkey").cast("string"), 4, "0")),
        F.lit("email"), F.concat(F.lit("u"), F.col("c_custkey"), F.lit("@example.com")),
        F.lit("gender"), F.when(F.col("c_custkey") % 3 == 0, F.lit("F"))
                          .when(F.col("c_custkey") % 3 == 1, F.lit("M")),
        F.lit("birthday"), (F.lit(3000) + (F.col("c_custkey") * 37) % 15000).cast("string")), F.col("t"))


def _user_sup() -> _Change:
    t = F.col("t") + (F.col("c_custkey") % 61) * 60_000
    return _Change("user_info_sup_msg", "c", None, F.create_map(
        F.lit("uid"), F.col("c_custkey").cast("string"),
        F.lit("height"), (F.lit(150) + F.col("c_custkey") % 40).cast("string"),
        F.lit("unit_height"), F.lit("cm"),
        F.lit("weight"), (F.lit(45) + F.col("c_custkey") % 50).cast("string"),
        F.lit("unit_weight"), F.lit("kg"),
        F.lit("create_ts"), t.cast("string")), t)


def user_changes(customer: DataFrame) -> DataFrame:
    """`customer` → ``user_info`` inserts; birthday is an epoch day."""
    return _branches(_user_rows(customer), _user_info())


def user_sup_changes(customer: DataFrame) -> DataFrame:
    """`customer` → ``user_info_sup_msg`` inserts (height / weight), created
    ``custkey mod 61`` minutes after the user row, so some fall outside ±30 min."""
    return _branches(_user_rows(customer), _user_sup())


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def all_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``topic_db`` stream derived from the driver tables, for jobs
    that read (nearly) all of it: every table is scanned once."""
    return _union([
        order_table_changes(spark, sf_dir),
        _line_changes(table(spark, sf_dir, "lineitem"), _emit),
        _cart_changes(table(spark, sf_dir, "events"), _emit),
        comment_changes(table(spark, sf_dir, "documents")),
        _emit(_user_rows(table(spark, sf_dir, "customer")), _user_info(), _user_sup()),
    ])


def table_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream for jobs that read a few tables of it: a union with one
    branch per kind of record, which ``table_changes`` prunes."""
    customers = table(spark, sf_dir, "customer")
    return _union([
        _branches(_order_rows(table(spark, sf_dir, "orders")), *_order_info(), *_payment_info(),
                  *_refund_info()),
        detail_changes(table(spark, sf_dir, "lineitem")),
        cart_changes(table(spark, sf_dir, "events")),
        comment_changes(table(spark, sf_dir, "documents")),
        user_changes(customers), user_sup_changes(customers),
    ])


def changes_as_text(changes: DataFrame) -> DataFrame:
    """Envelopes serialised to JSON text (the wire format).  Every 97th record
    by ``ts_ms`` is corrupted so parsers see bad input."""
    js = F.to_json(F.struct("before", "after", "source", "op", "ts_ms"))
    return changes.select(F.when(F.col("ts_ms") % 97 == 0, F.substring(js, 1, 30))
                          .otherwise(js).alias("value"))
