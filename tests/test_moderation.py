from pyspark.sql import functions as F

from tests.conftest import rows
from tillstream.operators import moderation as m


def _base(spark, msgs):
    return spark.createDataFrame([(i, t) for i, t in enumerate(msgs)], "id int, msg string")


def test_p0_p1_cases(spark):
    msgs = ["nice phone,idiot",        # last token listed → P0
            "you are stupid, ok",      # middle word only → P1
            "",                        # empty text → clean
            ",",                       # no tokens → clean
            "all good",                # no hit
            "hate it,token,stupid"]    # P0 wins over P1
    words = m.words_df(spark)
    out = m.flag_any_word(m.flag_last_token(_base(spark, msgs), words), words)
    got = rows(out, "id", "is_violation", "violation_grade", "violation_msg")
    assert got == [(0, 1, "P0", "idiot"), (1, 0, "P1", "stupid"), (2, 0, "", ""), (3, 0, "", ""),
                   (4, 0, "", ""), (5, 1, "P0", "stupid")]


def test_find_words_in_texts_and_tables(spark):
    texts = spark.createDataFrame([(1, "I hate tokens and idiots"), (2, "clean"), (3, None), (4, ""),
                                   (5, "I hate tokens and idiots"), (6, "hat")], "id int, t string")
    got = rows(m.find_words(texts, "t", m.words_df(spark)).select("id", F.array_join("found", ",")))
    assert got == [(1, "hate,idiot,token"), (2, ""), (3, ""), (4, ""), (5, "hate,idiot,token"), (6, "")]
    empty = spark.createDataFrame([("",)], "word string")
    assert {r.n for r in m.find_words(texts, "t", empty).select(F.size("found").alias("n")).collect()} == {0}


def test_one_message_per_order_and_time(spark):
    j = spark.createDataFrame(
        [(1, 7, "c", 10, "20240101", "text", 5, "c", "1001", 9), (1, 7, "c", 10, "20240101", "text", 4, "u", "1002", 9),
         (1, 8, "c", 10, "20240101", "text", 4, "u", "1002", 9)],
        "order_id bigint, ts_ms bigint, info_consignee string, user_id bigint, ds string, comment_txt string, "
        "info_tm_ms bigint, info_op string, info_order_status string, id bigint")
    assert m.messages(j).count() == 2


def test_in_words_membership(spark):
    df = spark.createDataFrame([("hate",), ("love",), (None,)], "w string")
    got = rows(m.in_words(df, "w", m.words_df(spark)), "w", "in_words")
    assert got == [(None, False), ("hate", True), ("love", False)]
