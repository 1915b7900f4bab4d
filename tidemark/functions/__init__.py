"""Column functions: scalar expressions, text parsing, calendar parts and aggregate helpers."""

from tidemark.functions.aggregates import count_where, percent, total
from tidemark.functions.calendar import (
    duration_minutes,
    month_key,
    month_label,
    month_name,
    month_start,
    quarter_label,
)
from tidemark.functions.parsing import (
    NULL_TOKENS,
    POSITION,
    blank_to_null,
    date_class,
    is_iso_date,
    iso_date,
    parse_amount,
    parse_date,
    parse_number,
    parse_timestamp,
    strip,
)
from tidemark.functions.scalars import (
    bin_label,
    clip,
    delay_days,
    finite,
    holds,
    hour_of_elapsed,
    log_amount,
    on_time_flag,
    relative_gap,
    safe_ratio,
    show_count,
    show_percent,
)

__all__ = [
    "NULL_TOKENS",
    "POSITION",
    "bin_label",
    "blank_to_null",
    "clip",
    "count_where",
    "date_class",
    "delay_days",
    "duration_minutes",
    "finite",
    "holds",
    "hour_of_elapsed",
    "is_iso_date",
    "iso_date",
    "log_amount",
    "month_key",
    "month_label",
    "month_name",
    "month_start",
    "on_time_flag",
    "parse_amount",
    "parse_date",
    "parse_number",
    "parse_timestamp",
    "percent",
    "quarter_label",
    "relative_gap",
    "safe_ratio",
    "show_count",
    "show_percent",
    "strip",
    "total",
]
