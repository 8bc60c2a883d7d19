"""Column-level helpers.  All are built-in Spark expressions,
so they stay inside whole-stage codegen."""

from tillstream.functions.dates import (  # noqa: F401
    age_years, decade, epoch_day_to_date, ms_to_compact_date, ms_to_date,
    ms_to_datetime, ntz_millis, text_to_date, text_to_ms, whole_days_between,
    window_bounds, zodiac_sign,
)
from tillstream.functions.text import (  # noqa: F401
    empty_or_null, first_token, json_get, last_token, map_keep_keys, tokens,
)
