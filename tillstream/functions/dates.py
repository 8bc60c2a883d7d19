"""Date and time expressions (FN-1 … FN-10, FN-23).

Epoch values are milliseconds held in ``bigint`` columns, as in the change
records and click logs.  Rendering to text uses the session time zone
(``spark.sql.session.timeZone``); parsing wall-clock text uses a fixed offset
so results never depend on where the executor runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstream.functions.text import _c


def ms_to_datetime(ms) -> Column:
    """FN-1 epoch ms → ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(F.timestamp_millis(_c(ms)), "yyyy-MM-dd HH:mm:ss")


def ms_to_date(ms) -> Column:
    """FN-1 epoch ms → ``yyyy-MM-dd``."""
    return F.date_format(F.timestamp_millis(_c(ms)), "yyyy-MM-dd")


def ms_to_compact_date(ms) -> Column:
    """FN-1 epoch ms → ``yyyyMMdd`` (the ``ds`` partition value)."""
    return F.date_format(F.timestamp_millis(_c(ms)), "yyyyMMdd")


def ntz_millis(ts_ntz) -> Column:
    """Epoch ms of a ``timestamp_ntz`` wall clock read as UTC; zone free."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts_ntz))


def text_to_ms(text, offset_hours: int = 8) -> Column:
    """FN-2 ``yyyy-MM-dd[ HH:mm:ss]`` text → epoch ms at a fixed UTC offset;
    null when the text is no time."""
    return ntz_millis(_c(text).try_cast("timestamp_ntz")) - F.lit(offset_hours * 3_600_000)


def text_to_date(text) -> Column:
    """FN-4 ``date_format(x, 'yyyy-MM-dd')`` where x is datetime text or epoch ms text."""
    x = _c(text)
    parsed = F.coalesce(
        F.try_to_timestamp(x),
        F.timestamp_millis(x.try_cast("bigint")),
    )
    return F.date_format(parsed, "yyyy-MM-dd")


def epoch_day_to_date(days) -> Column:
    """FN-6 days since 1970-01-01 → ``date``."""
    return F.date_from_unix_date(_c(days).try_cast("int"))


def decade(date_col) -> Column:
    """FN-7 first three digits of the ISO year + ``0`` (``1994`` → ``1990``)."""
    return F.concat(F.substring(F.date_format(_c(date_col), "yyyy-MM-dd"), 1, 3), F.lit("0"))


def age_years(birth, today) -> Column:
    """FN-8 whole years from ``birth`` to ``today`` (period years, not
    ``months_between``, which differs on month ends)."""
    b, t = _c(birth), _c(today)
    not_reached = (F.month(t) * 100 + F.dayofmonth(t)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(t) - F.year(b) - F.when(not_reached, 1).otherwise(0)).cast("int")


# Sign names and the last day (month*100+day) of each sign, in
# calendar order starting from January.  Dates after 12-21 wrap to the first.
ZODIAC_LAST_DAYS = [
    (119, "摩羯座"),
    (218, "水瓶座"),
    (320, "双鱼座"),
    (419, "白羊座"),
    (520, "金牛座"),
    (621, "双子座"),
    (722, "巨蟹座"),
    (822, "狮子座"),
    (922, "处女座"),
    (1023, "天秤座"),
    (1122, "天蝎座"),
    (1221, "射手座"),
]
ZODIAC_WRAP = "摩羯座"


def zodiac_sign(date_col) -> Column:
    """FN-9 western zodiac sign name of a date."""
    md = F.month(_c(date_col)) * 100 + F.dayofmonth(_c(date_col))
    expr = None
    for last, name in ZODIAC_LAST_DAYS:
        expr = F.when(md <= last, F.lit(name)) if expr is None else expr.when(md <= last, F.lit(name))
    return F.when(_c(date_col).isNull(), F.lit(None)).otherwise(expr.otherwise(F.lit(ZODIAC_WRAP)))


def whole_days_between(later_ms, earlier_ms) -> Column:
    """FN-10 whole days between two epoch-ms values (integer division)."""
    d = _c(later_ms) - _c(earlier_ms)
    return ((d - F.pmod(d, F.lit(86_400_000))) / F.lit(86_400_000)).cast("bigint")


def window_bounds(window_col="window") -> list[Column]:
    """FN-23 ``stt``/``edt``/``cur_date`` text columns from a ``window`` struct."""
    w = _c(window_col)
    return [
        F.date_format(w["start"], "yyyy-MM-dd HH:mm:ss").alias("stt"),
        F.date_format(w["end"], "yyyy-MM-dd HH:mm:ss").alias("edt"),
        F.date_format(w["start"], "yyyy-MM-dd").alias("cur_date"),
    ]
