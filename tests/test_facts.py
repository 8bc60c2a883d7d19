from tests.conftest import rows
from tillstream.operators import facts

ENV = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint"


def _src(t, ts=1):
    return {"table": t, "ts_ms": str(ts)}


def test_cart_add_cases(spark):
    ch = spark.createDataFrame([
        (None, {"id": "1", "user_id": "u", "sku_id": "s", "sku_num": "2"}, _src("cart_info"), "c", 1),
        ({"sku_num": "2"}, {"id": "2", "user_id": "u", "sku_id": "s", "sku_num": "5"}, _src("cart_info"), "u", 2),
        ({"sku_num": "5"}, {"id": "3", "user_id": "u", "sku_id": "s", "sku_num": "5"}, _src("cart_info"), "u", 3),
        ({"sku_num": "5"}, {"id": "4", "user_id": "u", "sku_id": "s", "sku_num": "4"}, _src("cart_info"), "u", 4),
        ({"id": "5"}, {"id": "5", "user_id": "u", "sku_id": "s", "sku_num": "9"}, _src("cart_info"), "u", 5),
        (None, {"id": "6", "sku_num": "1"}, _src("order_info"), "c", 6),
    ], ENV)
    assert rows(facts.cart_add(ch), "id", "sku_num") == [("1", "2"), ("2", "3"), ("3", "0")]


def _detail_changes(spark):
    def od(i, oid, ts):
        return (None, {"id": i, "order_id": oid, "sku_id": "7", "sku_name": "n", "create_time": ts,
                       "sku_num": "1", "order_price": "6999.0", "split_total_amount": "6499.0",
                       "split_activity_amount": "500.0", "split_coupon_amount": "0.0"},
                _src("order_detail", 100), "c", 100)
    return spark.createDataFrame([
        od("d1", "o1", "2024-06-11 19:35:25"),   # activity + coupon
        od("d2", "o1", "1718278525000"),         # create time as epoch ms text, no links
        od("d3", "o2", "2024-06-12 10:00:00"),   # order arrives later (batch: still joined)
        od("d4", "o9", "2024-06-12 10:00:00"),   # order never arrives: dropped (inner)
        (None, {"id": "o1", "user_id": "616", "province_id": "17"}, _src("order_info", 90), "c", 90),
        (None, {"id": "o2", "user_id": "617", "province_id": "18"}, _src("order_info", 200), "c", 200),
        (None, {"order_detail_id": "d1", "activity_id": "1", "activity_rule_id": "2"},
         _src("order_detail_activity"), "c", 1),
        (None, {"order_detail_id": "d1", "coupon_id": "3"}, _src("order_detail_coupon"), "c", 1),
        ({"id": "o1", "order_status": "1001"}, {"id": "o1", "order_status": "1003",
                                                "operate_time": "2024-06-13 08:00:00"},
         _src("order_info", 300), "u", 300),
        ({"id": "o2", "order_status": "1002"}, {"id": "o2", "order_status": "1003",
                                                "operate_time": "2024-06-13 08:00:00"},
         _src("order_info", 301), "u", 301),
    ], ENV)


def test_order_detail_links_and_amounts(spark):
    od = facts.order_detail(_detail_changes(spark))
    got = rows(od, "id", "user_id", "activity_id", "coupon_id", "date_id", "split_original_amount")
    assert got == [("d1", "616", "1", "3", "2024-06-11", "6999.0000"),
                   ("d2", "616", None, None, "2024-06-13", "6999.0000"),
                   ("d3", "617", None, None, "2024-06-12", "6999.0000")]


def test_order_cancel_requires_1001_to_1003(spark):
    ch = _detail_changes(spark)
    got = rows(facts.order_cancel(ch, facts.order_detail(ch)), "id", "order_cancel_date_id", "ts_ms")
    assert got == [("d1", "2024-06-13", 300), ("d2", "2024-06-13", 300)]


def test_payment_unknown_code_dropped(spark):
    ch = spark.createDataFrame([
        ({"payment_status": "1601"}, {"user_id": "u", "order_id": "o1", "payment_type": "1101",
                                      "callback_time": "t", "payment_status": "1602"},
         _src("payment_info", 5), "u", 5),
        ({"payment_status": "1601"}, {"user_id": "u", "order_id": "o1", "payment_type": "9999",
                                      "callback_time": "t", "payment_status": "1602"},
         _src("payment_info", 6), "u", 6),
    ], ENV)
    details = facts.order_detail(_detail_changes(spark))
    dic = spark.createDataFrame([("1101", "alipay")], "dic_code string, dic_name string")
    got = rows(facts.payment_success(ch, details, dic), "order_detail_id", "payment_type_name")
    assert got == [("d1", "alipay"), ("d2", "alipay")]


def _odd_changes(spark):
    """Repeated orders, lines, links and events, null keys, and amounts in odd texts."""
    ch = _detail_changes(spark)
    line = lambda i, oid, num, price, a, b, c: (
        None, {"id": i, "order_id": oid, "sku_id": "7", "sku_name": "n", "create_time": "2024-06-11 19:35:25",
               "sku_num": num, "order_price": price, "split_total_amount": a, "split_activity_amount": b,
               "split_coupon_amount": c}, _src("order_detail", 101), "c", 101)
    more = [line("d5", "o1", "2", "0010.50", "12.3", "bad", None), line("d6", "o2", None, "x", "-0.00", " 7", "1e3"),
            line(None, "o1", "1", "99999999999999.99", "1", "123456789012345678901.5", ""),
            line("d7", None, "1", "1", "1", "1", "1"),
            (None, {"id": None, "user_id": "9", "province_id": "1"}, _src("order_info"), "c", 1)]
    for t, col in [("u", "order_info"), ("u", "payment_info")]:
        for oid in ["o1", "o1", "o9", None]:
            more.append(({"id": oid, "order_status": "1001", "payment_status": "1601"},
                         {"id": oid, "order_id": oid, "user_id": "u", "order_status": "1003", "payment_status": "1602",
                          "payment_type": "1101", "operate_time": "2024-06-13 08:00:00", "callback_time": "t"},
                         _src(col, 400), t, 400))
    ch = ch.unionByName(spark.createDataFrame(more, ENV))
    return ch.unionByName(ch.where("source['table'] in ('order_info', 'order_detail_activity') and op = 'c'"))


def test_amounts_keep_their_text(spark):
    got = rows(facts.order_detail(_odd_changes(spark)).where("id is null or id in ('d5', 'd6')").distinct(),
               "id", "split_original_amount", "split_total_amount", "split_activity_amount", "split_coupon_amount")
    assert got == [(None, "99999999999999.9900", "1", "123456789012345678901.5", ""),
                   ("d5", "21.0000", "12.3", "bad", None), ("d6", None, "-0.00", " 7", "1e3")]


def test_events_met_before_the_lines_give_the_same_facts(spark):
    ch = _odd_changes(spark)
    details = facts.order_detail(ch)
    got = rows(facts.order_cancel(ch))
    assert got and got == rows(facts.order_cancel(ch, details))
    dic = spark.createDataFrame([("1101", "alipay")], "dic_code string, dic_name string")
    for interval in [None, (-300, 0), (-299, 0)]:
        got = rows(facts.payment_success(ch, None, dic, interval))
        assert got and got == rows(facts.payment_success(ch, details, dic, interval))
