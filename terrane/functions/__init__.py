"""Scalar and aggregate column helpers."""

from .measures import avg_ratio, count_distinct, count_if, exact_avg, exact_sum, flag_sum, median, rows
from .scalars import (
    content_hash,
    date_key,
    first_match,
    initcap_words,
    month_start,
    null_if_token,
    parse_date,
    parse_decimal,
    parse_int,
    pct_change,
    safe_ratio,
    surrogate_key,
)

__all__ = [
    "avg_ratio", "content_hash", "count_distinct", "count_if", "date_key", "exact_avg", "exact_sum",
    "first_match", "flag_sum", "initcap_words", "median", "month_start", "null_if_token",
    "parse_date", "parse_decimal", "parse_int", "pct_change", "rows", "safe_ratio",
    "surrogate_key",
]
