"""Column helpers. All are built-in expressions; none is a Python UDF."""

from quotelake.functions.dates import (
    calendar_text_date,
    compact_date,
    compact_date_int,
    days_between,
    eastern_offset_text,
    eastern_time,
    epoch_millis_utc,
    week_end,
)
from quotelake.functions.numbers import (
    half_away,
    round_scaled,
    round_stable,
    safe_ratio,
    strict_bigint,
    strict_double,
    try_bigint,
    try_double,
)
from quotelake.functions.text import (
    blank_to_null,
    canonical,
    first_replace,
    replace_all_text,
    title_case,
)

__all__ = [
    "blank_to_null",
    "calendar_text_date",
    "canonical",
    "compact_date",
    "compact_date_int",
    "days_between",
    "eastern_offset_text",
    "eastern_time",
    "epoch_millis_utc",
    "first_replace",
    "half_away",
    "replace_all_text",
    "round_scaled",
    "round_stable",
    "safe_ratio",
    "strict_bigint",
    "strict_double",
    "title_case",
    "try_bigint",
    "try_double",
    "week_end",
]
