"""Conforming rules for labels, units and series codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.names import apply_rules
from tessera.functions.text import _col
from tessera.specs import LABEL_RULES, SERIES_RULES, UNIT_RULES


def first_label(*levels) -> Column:
    """First non-null upper-cased label level."""
    return F.coalesce(*[F.upper(_col(c)) for c in levels])


def qualify_label(code, label, rules=LABEL_RULES) -> Column:
    """Append a suffix to, or replace, the label of listed codes."""
    code, label = _col(code), _col(label)
    expr = None
    for key, mode, text in rules:
        out = F.concat(label, F.lit(text)) if mode == "suffix" else F.lit(text)
        expr = (F.when if expr is None else expr.when)(code == F.lit(key), out)
    return label if expr is None else expr.otherwise(label)


def conform_units(c, rules=UNIT_RULES) -> Column:
    """Upper-case, then recode ('UNITS' -> 'NUMBER', 'NIGHTS' -> 'AVG_NIGHTS')."""
    u = F.upper(_col(c))
    expr = None
    for src, dst in rules:
        expr = (F.when if expr is None else expr.when)(u == F.lit(src), F.lit(dst))
    return u if expr is None else expr.otherwise(u)


def series_code(c, rules=SERIES_RULES) -> Column:
    """Long series description -> short indicator code; others unchanged."""
    return apply_rules(c, rules)
