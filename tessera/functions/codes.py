"""Hierarchical indicator codes and area-code remaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numeric import to_int
from tessera.functions.text import _col


def code_text(c) -> Column:
    """Indicator code text with dots for commas, trimmed."""
    return F.trim(F.replace(_col(c), F.lit(","), F.lit(".")))


def normalize_code(c, fixes=(), *, text=None) -> Column:
    """Indicator code text -> dotted code.

    ``,`` becomes ``.``; blank -> NULL; per-table fixes first; a code with a
    dot or of length one stays; otherwise a dot goes after the first char
    ('219' -> '2.19', '22' -> '2.2'). ``text`` may pass a precomputed ``code_text(c)``.
    """
    t = code_text(c) if text is None else _col(text)
    expr = F.when(F.nullif(t, F.lit("")).isNull(), F.lit(None).cast("string"))
    for src, dst in fixes:
        expr = expr.when(t == F.lit(src), F.lit(dst))
    return (expr.when(F.instr(t, ".") > 0, t)
                .when(F.length(F.rtrim(t)) == 1, t)
                .otherwise(F.overlay(t, F.lit("."), 2, 0)))


def remap_values(c, mapping) -> Column:
    """Simultaneous value remap: every branch reads the input, never another output."""
    c = _col(c)
    expr = None
    for src, dst in mapping:
        expr = (F.when if expr is None else expr.when)(c == F.lit(src), F.lit(dst))
    return c if expr is None else expr.otherwise(c)


def remap_area_code(c, mapping) -> Column:
    return remap_values(to_int(c), mapping)
