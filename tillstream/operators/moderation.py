"""Comment moderation (JN-7, JN-15, JN-23, PRJ-13, PRJ-22 … PRJ-24, MOD-1, MOD-2).

The word list is a table whose size is counted first.  A short list is searched
for inside the row; any other is an index of rare n-grams: each word is keyed by
its rarest n-gram, a text's n-grams meet the keys, and the few (text, word) pairs
that meet are checked for the whole word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.dates import ms_to_compact_date
from tillstream.functions.text import last_token
from tillstream.operators.cdc import row_image_flat, table_changes
from tillstream.operators.joins import interval_join, lookup
from tillstream.operators.label import dedup_first
from tillstream.session import fixed_table, materialize

# The sensitive-word dictionary used by the registered queries
# (a deployment loads its own list with ``load_words``).
WORDS = ["idiot", "stupid", "hate", "token", "License"]


def words_df(spark: SparkSession, words: list[str] | None = None) -> DataFrame:
    return fixed_table(spark, [(w,) for w in (words or WORDS)], "word string")


def comment_images(changes: DataFrame) -> DataFrame:
    """PRJ-22: flattened comment records."""
    c = table_changes(changes, "comment_info").where(F.col("after").isNotNull())
    a = F.col("after")
    return c.select(
        "ts_ms", F.col("source")["db"].alias("db"), F.col("source")["table"].alias("table"),
        F.col("source")["server_id"].alias("server_id"), a["appraise"].alias("appraise"),
        a["comment_txt"].alias("comment_txt"), "op", a["nick_name"].alias("nick_name"),
        a["create_time"].alias("create_time"), a["user_id"].try_cast("bigint").alias("user_id"),
        a["sku_id"].try_cast("bigint").alias("sku_id"), a["id"].try_cast("bigint").alias("id"),
        a["spu_id"].try_cast("bigint").alias("spu_id"), a["order_id"].try_cast("bigint").alias("order_id"))


def comment_rows(changes: DataFrame, dic: DataFrame) -> DataFrame:
    """PRJ-22 + JN-7: flattened comment records with the appraisal name
    (``N/A`` when the code is unknown)."""
    return lookup(comment_images(changes), dic, [("appraise", "dic_code")], {"dic_name": "dic_name"},
                  default="N/A")


def order_rows(changes: DataFrame) -> DataFrame:
    """PRJ-13: order_info images flattened with ``op`` and ``tm_ms``."""
    o = row_image_flat(table_changes(changes, "order_info"))
    d = F.col("data")
    return o.select(d["id"].try_cast("bigint").alias("id"), d["user_id"].alias("user_id"),
                    d["consignee"].alias("consignee"), d["trade_body"].alias("trade_body"),
                    d["order_status"].alias("order_status"), d["op"].alias("op"),
                    d["tm_ms"].try_cast("bigint").alias("tm_ms"))


def comment_with_order(comments: DataFrame, orders: DataFrame,
                       lower_ms: int = -60_000, upper_ms: int = 60_000) -> DataFrame:
    """JN-15 + PRJ-23 + PRJ-24: comments ⨝ their order's records within ±1 min,
    order columns prefixed ``info_``; ``ds`` = yyyyMMdd of the comment time."""
    j = interval_join(comments, orders, [("order_id", "id")], "ts_ms", "tm_ms",
                      lower_ms, upper_ms, right_prefix="info_")
    return j.withColumn("ds", ms_to_compact_date(F.col("ts_ms")))


def in_words(df: DataFrame, col: str, words: DataFrame, flag: str = "in_words") -> DataFrame:
    """JN-23: boolean set membership of ``col`` (left join on the distinct words)."""
    w = words.select(F.col("word").alias("_w")).distinct().withColumn("_hit", F.lit(True))
    j = df.join(w, df[col] == w["_w"], "left")
    return j.select(*[df[c] for c in df.columns], F.coalesce(F.col("_hit"), F.lit(False)).alias(flag))


def flag_last_token(df: DataFrame, words: DataFrame, text_col: str = "msg") -> DataFrame:
    """MOD-1: the last comma token of the text is a listed word → violation P0."""
    d = df.withColumn("_last", F.coalesce(last_token(F.col(text_col), ","), F.lit("")))
    d = in_words(d, "_last", words, "_p0")
    return d.select(
        *[c for c in df.columns],
        F.col("_p0").cast("int").alias("is_violation"),
        F.when(F.col("_p0"), F.lit("P0")).otherwise(F.lit("")).alias("violation_grade"),
        F.when(F.col("_p0"), F.col("_last")).otherwise(F.lit("")).alias("violation_msg"))


# Dictionaries up to this size are looked for word by word inside the row; the
# words themselves are then a bounded literal of the plan.
IN_ROW = 128
# Keys up to this number are met inside the row before anything is exploded.
IN_ROW_KEYS = 4096


def _grams(text, n: int):
    """The distinct n-character pieces of a text, in one pass of a look-ahead."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1))


def keyed_words(words: DataFrame) -> tuple[DataFrame, int] | None:
    """(word, key) and the key length n, the shortest word's: a word's key is
    that of its n-grams which the fewest words share (the first of equals).
    None without a word."""
    w = words.select("word").where(F.length("word") > 0).distinct()
    n = w.agg(F.min(F.length("word"))).first()[0]
    if n is None:
        return None
    grams = w.select("word", F.explode(_grams(F.col("word"), n)).alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("n_words"))
    rarest = grams.join(shared, "gram").groupBy("word").agg(F.min(F.struct("n_words", "gram")).alias("_k"))
    return rarest.select("word", F.col("_k.gram").alias("key")), n


def matched_words(texts: DataFrame, key_col: str, text_col: str, words: DataFrame) -> DataFrame:
    """FN-21: ``(key, word)`` for every dictionary word that occurs in a text
    (substring match), for dictionaries of any size.  ``key_col`` names a text;
    empty words match nothing.

    Words meet texts by their rarest n-gram.  Up to ``IN_ROW_KEYS`` keys are
    intersected with a text's n-grams inside the row, so only hits are exploded
    and moved; the text goes along with its few hits and is read once."""
    keyed = keyed_words(words)
    if keyed is None:
        return texts.select(key_col, F.lit("").alias("word")).limit(0)
    table, n = keyed
    table = materialize(table, "words-by-key")
    t = F.col(text_col)
    grams = _grams(t, n)
    if table.select("key").distinct().count() <= IN_ROW_KEYS:
        grams = F.array_intersect(grams, table.agg(F.collect_set("key")).scalar())
    hits = texts.where(F.length(t) >= n).select(key_col, text_col, F.explode(grams).alias("key"))
    return (hits.join(table, "key").where(F.contains(t, F.col("word"))).select(key_col, "word").distinct())


def find_words(texts: DataFrame, text_col: str, words: DataFrame) -> DataFrame:
    """``texts`` + ``found``: the sorted distinct dictionary words in each text.

    A dictionary of at most ``IN_ROW`` words (counted here) is searched for
    inside the row: no shuffle, one pass over the input.  A larger one goes
    through :func:`matched_words`; the input is then written once, and equal
    texts are matched once."""
    listed = [r["word"] for r in words.select("word").where(F.length("word") > 0).distinct()
              .limit(IN_ROW + 1).collect()]
    none = F.array().cast("array<string>")
    if len(listed) <= IN_ROW:
        t = F.coalesce(F.col(text_col), F.lit(""))
        found = F.filter(F.array(*[F.lit(w) for w in sorted(listed)]), lambda w: F.contains(t, w)) \
            if listed else none
        return texts.withColumn("found", F.array_sort(found))
    keyed = materialize(texts.withColumn("_text_key", F.md5(F.coalesce(F.col(text_col), F.lit("")))), "texts")
    each = keyed.groupBy("_text_key").agg(F.any_value(text_col).alias("_t"))
    hits = (matched_words(each, "_text_key", "_t", words)
            .groupBy("_text_key").agg(F.array_sort(F.collect_set("word")).alias("found")))
    return keyed.join(hits, "_text_key", "left").select(
        *texts.columns, F.coalesce("found", none).alias("found"))


def flag_any_word(df: DataFrame, words: DataFrame, text_col: str = "msg") -> DataFrame:
    """MOD-2: when the first check found nothing, any dictionary word inside the
    text gives grade P1 and the words joined by ``", "``; ``is_violation`` stays
    0 as in the reference output."""
    p1 = (F.col("is_violation") == 0) & (F.size("found") > 0)
    return find_words(df, text_col, words).select(
        *[c for c in df.columns if c not in ("violation_grade", "violation_msg")],
        F.when(p1, F.lit("P1")).otherwise(F.col("violation_grade")).alias("violation_grade"),
        F.when(p1, F.array_join("found", ", ")).otherwise(F.col("violation_msg")).alias("violation_msg"))


# Which of several rows of one (order, time) is checked: the first by these.
FIRST_BY = ["info_tm_ms", "info_op", "info_order_status", "id"]


def messages(joined: DataFrame) -> DataFrame:
    """The rows to check: one per (order, time) of the comment ⨝ order rows."""
    return message_columns(dedup_first(joined, ["order_id", "ts_ms"], FIRST_BY))


def message_columns(once: DataFrame) -> DataFrame:
    return once.select("user_id", F.col("info_consignee").alias("consignee"), "ts_ms", "ds",
                       F.col("comment_txt").alias("msg"))


def blacklist(joined: DataFrame, words: DataFrame) -> DataFrame:
    """MOD-1 then MOD-2 on the comment ⨝ order rows → blacklist table rows."""
    return checked(messages(joined), words)


def checked(msgs: DataFrame, words: DataFrame) -> DataFrame:
    """MOD-1 then MOD-2 on the messages."""
    return flag_any_word(flag_last_token(msgs, words), words)
