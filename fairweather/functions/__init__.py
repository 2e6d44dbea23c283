"""Column functions: each takes columns and returns a column, JVM-side only."""

from fairweather.functions.dates import day_bounds, format_day, parse_day, parse_validity
from fairweather.functions.geo import degree_distance
from fairweather.functions.text import (
    NULL_TOKENS,
    address_key,
    clean_key,
    combination_key,
    department_key,
    null_tokens,
    parse_decimal_comma,
)

__all__ = [
    "NULL_TOKENS",
    "address_key",
    "clean_key",
    "combination_key",
    "day_bounds",
    "degree_distance",
    "department_key",
    "format_day",
    "null_tokens",
    "parse_day",
    "parse_decimal_comma",
    "parse_validity",
]
