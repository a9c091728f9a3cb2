"""Numeric text parsing (cells of the wide tables, SDG values)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import PLACEHOLDER, _col

# Plain decimal notation only: a source TRY_CONVERT to DECIMAL refuses
# exponent forms such as '1E5', which Spark's cast would accept.
DECIMAL_TEXT = r"^[+-]?[0-9]*\.?[0-9]*$"


def to_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """Text -> DECIMAL(p,s) or NULL: no exponent, half-up rounding, NULL on overflow."""
    c = _col(c)
    return F.when(c.rlike(DECIMAL_TEXT), c.try_cast(f"decimal({precision},{scale})"))


def parse_numeric_text(c, precision: int = 18, scale: int = 2) -> Column:
    """Wide-table cell: drop '..', drop ',' thousands separators, trim, '' -> NULL, decimal."""
    c = _col(c)
    text = F.replace(F.replace(c, F.lit(PLACEHOLDER), F.lit("")), F.lit(","), F.lit(""))
    # most cells are empty: told by a comparison; other blanks by the cast, which has no value for ''
    return F.when(~c.isin(PLACEHOLDER, ""), to_decimal(F.trim(text), precision, scale))


def parse_plain_decimal(c, precision: int = 18, scale: int = 2,
                        strip_thousands: bool = False) -> Column:
    """SDG value: conversion only, no placeholder or separator removal (as coded).

    ``strip_thousands=True`` follows the written notes instead ('1,234' -> 1234).
    """
    c = _col(c)
    if strip_thousands:
        c = F.replace(c, F.lit(","), F.lit(""))
    return to_decimal(F.trim(c), precision, scale)


def to_int(c) -> Column:
    """``TRY_CONVERT(INT, s)``; a blank gives NULL (0 is not a valid code)."""
    return F.trim(_col(c)).try_cast("int")
