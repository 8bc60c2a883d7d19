"""Text, JSON and map helpers (FN-15 … FN-22, UDX-1 tokens)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def last_token(text, sep: str = ",") -> Column:
    """FN-15 last token after splitting on a literal separator; null when none."""
    parts = F.filter(F.split(_c(text), _regex_escape(sep)), lambda t: t != "")
    return F.when(F.size(parts) > 0, F.element_at(parts, -1))


def first_token(text, sep: str = ",") -> Column:
    """FN-15 / TOP-4 first token of a joined text."""
    return F.split(_c(text), _regex_escape(sep)).getItem(0)


def empty_or_null(x) -> Column:
    """FN-22 ``StringUtils.isEmpty`` equivalent."""
    return F.coalesce(_c(x), F.lit("")) == ""


def json_get(text, path: str) -> Column:
    """FN-16 nested JSON get on text."""
    return F.get_json_object(_c(text), path)


def map_keep_keys(m, keys_csv) -> Column:
    """FN-17 / PRJ-14 keep only map entries whose key is in a comma list column.
    A null list keeps everything."""
    keys = F.split(_c(keys_csv), ",")
    return F.when(_c(keys_csv).isNull(), _c(m)).otherwise(
        F.map_filter(_c(m), lambda k, v: F.array_contains(keys, k)))


# Latin letters / digits form one token; every pair of adjacent CJK ideographs
# forms one token (a lone ideograph between non-CJK text is a token too).
_LATIN = r"[A-Za-z0-9]+"
_CJK = r"[\x{4E00}-\x{9FFF}]+"


def tokens(text) -> Column:
    """UDX-1 keyword tokens of a text as ``array<string>``: lower-cased Latin or
    digit runs, plus overlapping bigrams of each CJK run."""
    t = _c(text)
    latin = F.transform(F.regexp_extract_all(t, F.lit(_LATIN), 0), lambda s: F.lower(s))
    runs = F.regexp_extract_all(t, F.lit(_CJK), 0)
    bigrams = F.flatten(F.transform(runs, lambda r: F.when(
        F.length(r) == 1, F.array(r)).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, 2)))))
    return F.concat(latin, F.coalesce(bigrams, F.array().cast("array<string>")))


def _regex_escape(sep: str) -> str:
    import re
    return re.escape(sep)


def register_keywords(spark: SparkSession, name: str = "keywords") -> None:
    """UDX-1 for SQL users, a SQL table function over the expression of
    :func:`tokens`: ``SELECT k.word FROM pages, LATERAL keywords(pages.item) k``
    plans as one ``Generate``, without Python."""
    cjk = _CJK.replace("\\", "\\\\")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE(word STRING)
        RETURN SELECT k.word FROM (SELECT explode(concat(
          transform(regexp_extract_all(text, '{_LATIN}', 0), s -> lower(s)),
          coalesce(flatten(transform(regexp_extract_all(text, '{cjk}', 0), r ->
            CASE WHEN length(r) = 1 THEN array(r)
                 ELSE transform(sequence(1, length(r) - 1), i -> substring(r, i, 2)) END)),
            CAST(array() AS ARRAY<STRING>)))) AS word) k""")
