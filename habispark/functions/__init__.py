"""Column functions; each one is a composition of built-in Spark expressions."""

from habispark.functions.measures import exact_mean, int_round, price_per_m2, sale_year
from habispark.functions.parsing import (
    lenient_integer,
    lenient_number,
    normalize_null_tokens,
    parse_decimal_comma,
)
from habispark.functions.text import slugify

__all__ = [
    "exact_mean",
    "int_round",
    "lenient_integer",
    "lenient_number",
    "normalize_null_tokens",
    "parse_decimal_comma",
    "price_per_m2",
    "sale_year",
    "slugify",
]
