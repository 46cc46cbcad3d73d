"""Column functions F1-F13 (no Python UDFs)."""

from .json import parse_value, to_json_keep_nulls
from .numeric import (
    round_avg_money, round_avg_whole, round_ratio, to_money, try_double,
    try_int,
)
from .text import (
    initcap_words, money_text, normalize_city, normalize_state, short_id,
    surrogate_key,
)
from .timestamps import (
    add_days, add_seconds, iso_text, month_start, on_dates, parse_ts, parse_ts_one_format, to_ts,
    ts_text, utc_iso, whole_days_between,
)

__all__ = [
    "parse_value", "to_json_keep_nulls", "round_avg_money",
    "round_avg_whole", "round_ratio", "to_money", "try_double", "try_int",
    "initcap_words", "money_text", "normalize_city", "normalize_state", "short_id",
    "surrogate_key", "iso_text", "month_start", "add_days", "add_seconds", "on_dates", "parse_ts", "parse_ts_one_format",
    "to_ts", "ts_text", "utc_iso", "whole_days_between",
]
