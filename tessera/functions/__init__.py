"""Column -> Column rules. Each returns a built-in Spark expression."""

from tessera.functions.codes import normalize_code, remap_area_code, remap_values
from tessera.functions.conform import conform_units, first_label, qualify_label, series_code
from tessera.functions.dates import period_to_date, year_from_name, year_to_date
from tessera.functions.names import apply_rules, standardize_long_name, standardize_wide_name
from tessera.functions.numeric import parse_numeric_text, parse_plain_decimal, to_decimal, to_int
from tessera.functions.text import (
    any_of, blank_to_null, clean_text, collated, collated_equal, collation_key, exact, has_nonstandard_char,
    matches_any, null_noise, untrimmed,
)

__all__ = [
    "normalize_code", "remap_area_code", "remap_values", "conform_units", "first_label",
    "qualify_label", "series_code", "period_to_date", "year_from_name",
    "year_to_date", "apply_rules", "standardize_long_name", "standardize_wide_name",
    "parse_numeric_text", "parse_plain_decimal", "to_decimal", "to_int", "any_of",
    "blank_to_null", "clean_text", "collated", "collated_equal", "collation_key", "exact",
    "has_nonstandard_char", "matches_any", "null_noise", "untrimmed",
]
