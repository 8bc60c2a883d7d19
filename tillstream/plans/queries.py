"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (through the row-local adapters of
``tillstream.sources.driver``) and runs one warehouse operator over all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import functions
from tillstream.operators import cdc, dws, facts, label, logs, moderation, scoring, sequence, summary
from tillstream.operators.joins import lookup
from tillstream.sources import config as cfgsrc
from tillstream.sources import dims
from tillstream.sources import driver as drv
from tillstream.sources import sql as sqlsrc

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _log(spark, sf):
    return drv.events_log(drv.table(spark, sf, "events"))


def _pages(spark, sf):
    return dws.page_views(_log(spark, sf))


def _stream(spark, sf):
    """The whole change stream, one scan per table."""
    return drv.all_changes(spark, sf)


def _changes(spark, sf):
    """The change stream for jobs on a few tables of it."""
    return drv.table_branches(spark, sf)


def _details(spark, sf, links=True):
    return facts.order_detail(_changes(spark, sf), links)


def _image_text(m: str = "data"):
    """A map rendered as sorted ``key=value`` pairs joined by ``;`` (null values skipped)."""
    return F.array_join(F.array_sort(F.transform(
        F.map_entries(F.col(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


# ------------------------------------------------------------------ CDC
@query("cdc_parse")
def q_cdc_parse(spark, sf):
    # one pass: good and bad messages are counted from the same parse
    t = cdc.parse_envelope_tagged(drv.changes_as_text(_stream(spark, sf)))
    t = t.where(~F.col("_ok") | cdc.ods_filter_cond(keep_deletes=True))
    return t.groupBy(
        F.when(F.col("_ok"), F.col("source")["table"]).otherwise(F.lit("__corrupt__")).alias("tbl"),
        F.when(F.col("_ok"), F.col("op")).alias("op")).agg(F.count("*").alias("n_records"))


@query("cdc_table_filter")
def q_cdc_table_filter(spark, sf):
    c = cdc.table_changes(_changes(spark, sf), "order_info", ["u"])
    return c.select(F.col("after")["id"].alias("id"),
                    F.col("before")["order_status"].alias("old_status"),
                    F.col("after")["order_status"].alias("new_status"), "ts_ms")


@query("cdc_row_image")
def q_cdc_row_image(spark, sf):
    c = cdc.row_image(cdc.table_changes(_changes(spark, sf), "order_info"))
    return c.select(F.col("data")["id"].alias("id"), "op",
                    F.col("data")["order_status"].alias("order_status"), "ts_ms")


@query("config_latest")
def q_config_latest(spark, sf):
    routed = cdc.route_facts(_stream(spark, sf), cfgsrc.config_log(spark, cfgsrc.DWD_CONFIG_LOG))
    return routed.groupBy("sink_table").agg(
        F.count("*").alias("n_rows"),
        F.max(F.size("data")).alias("max_cols"))


@query("dwd_route")
def q_dwd_route(spark, sf):
    routed = cdc.route_facts(_stream(spark, sf), cfgsrc.config_log(spark, cfgsrc.DWD_CONFIG_LOG))
    return routed.select("sink_table", _image_text().alias("image"), "ts_ms")


@query("dim_route")
def q_dim_route(spark, sf):
    routed = cdc.route_dims(_stream(spark, sf), cfgsrc.config_log(spark, cfgsrc.DIM_CONFIG_LOG))
    return routed.select("sink_table", "row_key", "op", _image_text().alias("image"), "ts_ms")


@query("upsert_latest")
def q_upsert_latest(spark, sf):
    c = cdc.row_image(drv.order_info_changes(drv.table(spark, sf, "orders")))
    rows = c.select(F.col("data")["id"].alias("id"),
                    F.col("data")["order_status"].alias("order_status"), "ts_ms",
                    (F.col("op") == "d").alias("deleted"))
    inserts = rows.where(F.col("ts_ms").isNotNull() & ~F.col("deleted"))
    target = cdc.upsert(None, inserts.where(F.col("order_status") == "1001"), ["id"], ["ts_ms"],
                        delete_col="deleted")
    changes = rows.where(F.col("order_status") != "1001")
    return cdc.upsert(target, changes, ["id"], ["ts_ms"], delete_col="deleted")


# ------------------------------------------------------------------ logs
@query("log_etl")
def q_log_etl(spark, sf):
    # parsed logs and quarantined messages, from one parse
    parsed = logs.parse_log_tagged(drv.events_log_text(drv.table(spark, sf, "events")))
    return parsed.select(
        "log_id", F.when(F.col("_ok"), F.lit("ok")).otherwise(F.lit("bad")).alias("status"),
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts",
        F.col("common.is_new").alias("is_new"),
        F.coalesce(F.size("displays"), F.lit(0)).alias("n_displays"),
        F.coalesce(F.size("actions"), F.lit(0)).alias("n_actions"),
        F.col("err").isNotNull().cast("int").alias("has_err"),
        F.col("start").isNotNull().cast("int").alias("has_start"),
        F.when(~F.col("_ok"), F.length("_raw")).alias("bad_length"))


@query("is_new_repair")
def q_is_new_repair(spark, sf):
    fixed = sequence.repair_is_new(_log(spark, sf))
    return fixed.select("log_id", F.col("common.mid").alias("mid"), "ts",
                        F.col("common.is_new").alias("is_new"))


@query("log_split_counts")
def q_log_split_counts(spark, sf):
    return logs.split_counts(_log(spark, sf))


@query("log_displays")
def q_log_displays(spark, sf):
    d = logs.split_log(_log(spark, sf))["display"]
    return d.select("log_id", F.col("common.mid").alias("mid"),
                    F.col("page.page_id").alias("page_id"),
                    F.col("display")["item"].alias("item"),
                    F.col("display")["pos_id"].alias("pos_id"), "ts")


@query("log_actions")
def q_log_actions(spark, sf):
    a = logs.split_log(_log(spark, sf))["action"]
    return a.select("log_id", F.col("common.mid").alias("mid"),
                    F.col("page.page_id").alias("page_id"),
                    F.col("action")["action_id"].alias("action_id"),
                    F.col("action")["item"].alias("item"),
                    F.col("action")["ts"].alias("action_ts"))


# ------------------------------------------------------------------ facts
@query("dwd_cart_add")
def q_dwd_cart_add(spark, sf):
    return facts.cart_add(drv.cart_changes(drv.table(spark, sf, "events")))


@query("dwd_order_detail")
def q_dwd_order_detail(spark, sf):
    return _details(spark, sf)


@query("dwd_order_cancel")
def q_dwd_order_cancel(spark, sf):
    return facts.order_cancel(_changes(spark, sf))


@query("dwd_payment")
def q_dwd_payment(spark, sf):
    return facts.payment_success(_changes(spark, sf), None, dims.base_dic(spark))


@query("dwd_refund")
def q_dwd_refund(spark, sf):
    return facts.refund(_changes(spark, sf), dims.base_dic(spark))


@query("dwd_comment")
def q_dwd_comment(spark, sf):
    return facts.comment_fact(drv.comment_changes(drv.table(spark, sf, "documents")),
                              dims.base_dic(spark))


# The SQL forms of three fact jobs and the keyword job, over the declared tables.
@query("dwd_cart_add_sql")
def q_dwd_cart_add_sql(spark, sf):
    sqlsrc.register_tables(spark, drv.cart_changes(drv.table(spark, sf, "events")))
    return sqlsrc.cart_add(spark)


@query("dwd_comment_sql")
def q_dwd_comment_sql(spark, sf):
    sqlsrc.register_tables(spark, drv.comment_changes(drv.table(spark, sf, "documents")), dims.base_dic(spark))
    return sqlsrc.comment_fact(spark)


@query("dwd_refund_sql")
def q_dwd_refund_sql(spark, sf):
    sqlsrc.register_tables(spark, _changes(spark, sf), dims.base_dic(spark))
    return sqlsrc.refund(spark)


@query("dws_keyword_sql")
def q_dws_keyword_sql(spark, sf):
    sqlsrc.register_tables(spark, log=_log(spark, sf))
    return sqlsrc.keyword_count(spark)


@query("lookup_join")
def q_lookup_join(spark, sf):
    d = _details(spark, sf)
    d = lookup(d, dims.provinces(spark, sf), [("province_id", "id")], {"name": "province_name"})
    d = lookup(d, dims.sku_dims(spark, sf)["sku"], [("sku_id", "id")],
               {"sku_name": "dim_sku_name", "tm_id": "tm_id"}, default="N/A")
    return d.select("id", "order_id", "province_id", "province_name", "sku_id", "dim_sku_name",
                    "tm_id")


# ------------------------------------------------------------------ DWS
@query("dws_traffic_pv")
def q_dws_traffic_pv(spark, sf):
    return dws.traffic_window(_log(spark, sf), "10 seconds")


@query("dws_home_detail_uv")
def q_dws_home_detail_uv(spark, sf):
    return dws.home_detail_window(_log(spark, sf), "10 seconds")


@query("dws_cart_add_uu")
def q_dws_cart_add_uu(spark, sf):
    carts = facts.cart_add(drv.cart_changes(drv.table(spark, sf, "events")))
    return dws.cart_user_window(carts, "10 seconds")


@query("dws_user_login")
def q_dws_user_login(spark, sf):
    return dws.login_window(_pages(spark, sf), "1 second")


# A total order of a detail's versions, as far as any output can tell.
DETAIL_ORDER = ["ts_ms", "sku_id", "sku_num", "split_original_amount", "split_total_amount",
                "split_activity_amount", "split_coupon_amount", "activity_id", "coupon_id", "create_time"]


@query("retract_dedup")
def q_retract_dedup(spark, sf):
    r = sequence.retract_duplicates(_details(spark, sf), "id", dws.SKU_AMOUNTS, DETAIL_ORDER,
                                    keep=["sku_id", "ts_ms", *dws.SKU_AMOUNTS])
    return r.select("id", "sign", "sku_id", "ts_ms", *dws.SKU_AMOUNTS)


@query("dws_sku_order")
def q_dws_sku_order(spark, sf):
    return dws.sku_order_window_batch(_details(spark, sf, links=False), DETAIL_ORDER,
                                      dims.sku_flat(spark, sf), "10 seconds")


@query("dws_province_order")
def q_dws_province_order(spark, sf):
    return dws.province_order_window_batch(_details(spark, sf, links=False), DETAIL_ORDER,
                                           dims.provinces(spark, sf), "1 second")


@query("dwd_order_detail_latest")
def q_dwd_order_detail_latest(spark, sf):
    d = facts.latest_details(_details(spark, sf), [*DETAIL_ORDER, "activity_rule_id"])
    return d.select("id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "coupon_id",
                    "sku_num", *dws.SKU_AMOUNTS, "ts_ms")


@query("dws_keyword_count")
def q_dws_keyword_count(spark, sf):
    return dws.keyword_window(_pages(spark, sf), "1 second")


# ------------------------------------------------------------------ label
TODAY = "2025-06-15"


def _users(spark, sf):
    return label.user_profile(drv.user_changes(drv.table(spark, sf, "customer")), TODAY)


def _sups(spark, sf):
    return label.user_supplement(drv.user_sup_changes(drv.table(spark, sf, "customer")))


def _log_proj(spark, sf):
    return label.log_device_search(_log(spark, sf))


def _profile(spark, sf):
    return label.running_profile(label.dedup_rows(_log_proj(spark, sf)), 60_000)


def _hier(spark, sf):
    return label.category_hierarchy(dims.sku_dims(spark, sf))


def _log_scores(spark, sf):
    hier = label.flat_hierarchy(dims.sku_flat(spark, sf))
    return label.score_logs(_profile(spark, sf), hier, dims.category_compare(spark), spark)


def _order_changes(spark, sf):
    return drv.order_info_changes(drv.table(spark, sf, "orders")).unionByName(
        drv.detail_changes(drv.table(spark, sf, "lineitem")))


def _order_scores(spark, sf):
    o, d = label.order_projection(_order_changes(spark, sf))
    mapping = label.flat_brand_category(dims.sku_flat(spark, sf), dims.category_compare(spark))
    return label.score_orders(label.order_skus(o, d), mapping, spark)


@query("label_user_profile")
def q_label_user_profile(spark, sf):
    return _users(spark, sf)


@query("label_log_projection")
def q_label_log_projection(spark, sf):
    return _log_proj(spark, sf)


@query("label_order_projection")
def q_label_order_projection(spark, sf):
    return label.order_projection(_order_changes(spark, sf))[0]


@query("label_detail_projection")
def q_label_detail_projection(spark, sf):
    return label.order_projection(_order_changes(spark, sf))[1]


@query("label_user_activity")
def q_label_user_activity(spark, sf):
    return _profile(spark, sf)


@query("label_profile_values")
def q_label_profile_values(spark, sf):
    return label.profile_values(label.dedup_rows(_log_proj(spark, sf)), 60_000)


@query("label_order_values")
def q_label_order_values(spark, sf):
    return label.user_order_values(label.order_projection(_order_changes(spark, sf))[0])


@query("label_user_orders")
def q_label_user_orders(spark, sf):
    return label.user_orders_profile(label.order_projection(_order_changes(spark, sf))[0])


@query("last_per_window")
def q_last_per_window(spark, sf):
    pv = _pages(spark, sf).select("uid", "ts", "log_id", "page_id", "during_time")
    return label.last_per_window(pv, "uid", "ts", 60_000, ["ts", "log_id"])


@query("category_hierarchy")
def q_category_hierarchy(spark, sf):
    return _hier(spark, sf)


@query("sku_brand_category")
def q_sku_brand_category(spark, sf):
    return label.sku_brand_category(dims.sku_dims(spark, sf), dims.category_compare(spark))


@query("label_search_category")
def q_label_search_category(spark, sf):
    return _log_scores(spark, sf).select("uid", "window_start_ms", "last_search", "b1_category",
                                         "search_category")


@query("label_device_score")
def q_label_device_score(spark, sf):
    return _log_scores(spark, sf).select("uid", "window_start_ms", "judge_os",
                                         *[f"device_{b}" for b in scoring.BANDS])


@query("label_search_score")
def q_label_search_score(spark, sf):
    return _log_scores(spark, sf).select("uid", "window_start_ms", "search_category",
                                         *[f"search_{b}" for b in scoring.BANDS])


@query("label_order_score")
def q_label_order_score(spark, sf):
    return _order_scores(spark, sf)


@query("label_age_band")
def q_label_age_band(spark, sf):
    return label.age_band(_users(spark, sf), _order_scores(spark, sf), _log_scores(spark, sf))


@query("interval_join_30m")
def q_interval_join_30m(spark, sf):
    return label.enrich_user(_users(spark, sf), _sups(spark, sf))


@query("interval_join_12h")
def q_interval_join_12h(spark, sf):
    logs_ = _log_scores(spark, sf).select(
        F.col("uid").alias("l_uid"), F.col("ts").cast("bigint").alias("log_ts"), "judge_os",
        "search_category", *[f"{k}_{b}" for k in ("device", "search") for b in scoring.BANDS])
    users = _users(spark, sf).select("id", "ts_ms")
    j = label.interval_join(users, logs_, [("id", "l_uid")], "ts_ms", "log_ts",
                            -12 * 3_600_000, 12 * 3_600_000)
    return j.drop("l_uid")


@query("dedup_key")
def q_dedup_key(spark, sf):
    o, d = label.order_projection(_order_changes(spark, sf))
    return label.order_skus(o, d).select("order_id", "ts_ms", "sku_id", "detail_id")


@query("dedup_exact")
def q_dedup_exact(spark, sf):
    docs = drv.table(spark, sf, "documents").select("source", "lang", "text")
    return label.dedup_rows(docs).select("source", "lang", F.md5("text").alias("text_md5"),
                                         F.length("text").alias("n_chars"))


# ------------------------------------------------------------- moderation
def _comment_changes(spark, sf):
    return drv.comment_changes(drv.table(spark, sf, "documents"))


def _comments(spark, sf):
    return moderation.comment_rows(_comment_changes(spark, sf), dims.base_dic(spark))


def _comment_orders(spark, sf):
    orders = moderation.order_rows(drv.order_info_changes(drv.table(spark, sf, "orders")))
    return moderation.comment_with_order(_comments(spark, sf), orders)


@query("comment_dic_enrich")
def q_comment_dic_enrich(spark, sf):
    return _comments(spark, sf).select("id", "appraise", "dic_name", "user_id", "order_id",
                                       "nick_name", "ts_ms")


@query("comment_order_join")
def q_comment_order_join(spark, sf):
    return _comment_orders(spark, sf).select(
        "id", "order_id", "ts_ms", "info_id", "info_op", "info_tm_ms", "info_order_status",
        "info_consignee", "ds")


@query("ds_partition")
def q_ds_partition(spark, sf):
    c = _comments(spark, sf).withColumn("ds", functions.ms_to_compact_date(F.col("ts_ms")))
    return c.groupBy("ds").agg(F.count("*").alias("n_rows"))


@query("word_membership")
def q_word_membership(spark, sf):
    c = _comments(spark, sf).select(
        "id", F.coalesce(functions.last_token(F.col("comment_txt"), " "), F.lit("")).alias("last_word"))
    return moderation.in_words(c, "last_word", moderation.words_df(spark), "listed")


@query("moderation_p0")
def q_moderation_p0(spark, sf):
    return moderation.flag_last_token(moderation.messages(_comment_orders(spark, sf)),
                                      moderation.words_df(spark))


@query("moderation_p1")
def q_moderation_p1(spark, sf):
    return moderation.blacklist(_comment_orders(spark, sf), moderation.words_df(spark))


# -------------------------------------------------------------- functions
@query("fn_dates")
def q_fn_dates(spark, sf):
    ev = drv.table(spark, sf, "events").select("event_id", functions.ntz_millis("ts").alias("ts_ms"))
    dt = functions.ms_to_datetime("ts_ms")
    return ev.select(
        "event_id", "ts_ms", functions.ms_to_date("ts_ms").alias("d"), dt.alias("dt"),
        functions.ms_to_compact_date("ts_ms").alias("ds"),
        functions.text_to_ms(dt, 8).alias("ms_from_text_utc8"),
        functions.text_to_date(dt).alias("date_from_text"),
        functions.text_to_date(F.col("ts_ms").cast("string")).alias("date_from_ms_text"),
        functions.whole_days_between("ts_ms", F.lit(drv.BASE_MS)).alias("days_since_base"),
        F.date_format(functions.epoch_day_to_date(F.floor(F.col("ts_ms") / 86_400_000)),
                      "yyyy-MM-dd").alias("epoch_day_date"),
        *functions.window_bounds(F.window(F.timestamp_millis("ts_ms"), "1 hour")))


@query("fn_age_zodiac")
def q_fn_age_zodiac(spark, sf):
    c = drv.table(spark, sf, "customer").select(
        "c_custkey", functions.epoch_day_to_date(F.lit(3000) + (F.col("c_custkey") * 37) % 15000)
        .alias("bd"))
    return c.select(
        "c_custkey", F.date_format("bd", "yyyy-MM-dd").alias("birthday"),
        functions.decade("bd").alias("decade"),
        functions.age_years("bd", F.lit("2024-02-29").cast("date")).alias("age_leap"),
        functions.age_years("bd", F.lit(TODAY).cast("date")).alias("age_today"),
        functions.zodiac_sign("bd").alias("zodiac_sign"))


@query("fn_text_json")
def q_fn_text_json(spark, sf):
    d = drv.table(spark, sf, "documents")
    return d.select(
        "doc_id", F.md5("text").alias("text_md5"),
        F.length(F.coalesce(functions.last_token(F.col("text"), ","), F.lit(""))).alias("last_comma_len"),
        functions.first_token(F.col("text"), " ").alias("first_word"),
        functions.json_get(F.to_json(F.struct("doc_id", "lang", "source")), "$.lang").alias("json_lang"),
        functions.empty_or_null(F.col("source")).cast("int").alias("source_empty"),
        F.size(functions.tokens(F.col("text"))).alias("n_tokens"))


@query("run_summary")
def q_run_summary(spark, sf):
    ev = drv.table(spark, sf, "events").select(
        "event_id", functions.ntz_millis("ts").alias("ts_ms"),
        (F.col("event_type") != "error").alias("ok"),
        F.to_date("ts").cast("string").alias("run_day"))
    return summary.run_summary(ev, ["run_day"], "ok", "ts_ms")


@query("run_failed_ids")
def q_run_failed_ids(spark, sf):
    ev = drv.table(spark, sf, "events").select(
        "event_id", (F.col("event_type") != "error").alias("ok"),
        F.to_date("ts").cast("string").alias("run_day"))
    return summary.failed_ids(ev, ["run_day"], "ok", "event_id")
