"""Period and year helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numeric import to_int
from tessera.functions.text import _col


def year_to_date(year) -> Column:
    """``DATEFROMPARTS(y, 1, 1)``, NULL in -> NULL out; years outside 1..9999 give NULL."""
    y = _col(year)
    return F.when(y.between(1, 9999), F.make_date(y, F.lit(1), F.lit(1)))


def period_to_date(c) -> Column:
    """'YYYY' text -> DATE of January 1st."""
    return year_to_date(to_int(c))


def year_from_name(c) -> Column:
    """Column name 'year_1995' -> 1995 (right four characters parsed as a year)."""
    return F.year(F.try_to_date(F.right(_col(c), F.lit(4)), "yyyy"))
