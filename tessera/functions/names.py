"""Rule-list name standardisation (ordered; first match wins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import _col, clean_text, exact, null_noise
from tessera.specs import NOISE_PATTERNS


def apply_rules(c, rules, *, upper=None, lower=None) -> Column:
    """Ordered rule list over a cleaned value; unmatched values pass through.

    ``("eq", text, out)`` compares case-insensitively, ``("like", pattern, out)``
    is a case-insensitive LIKE (``lower(c) LIKE lower(pattern)``, which is what
    ILIKE means), ``("prefix", text, out)`` a case-insensitive starts-with.
    ``upper`` / ``lower`` may pass precomputed upper- and lower-cased forms of
    ``c``: conditions of later CASE branches are not shared by subexpression
    elimination, so an expensive input would otherwise be re-evaluated per rule.
    """
    c = _col(c)
    u = _col(upper) if upper is not None else F.upper(c)
    lo = _col(lower) if lower is not None else F.lower(c)
    expr = None
    for kind, pattern, out in rules:
        if kind == "eq":
            cond = u == F.lit(pattern.upper())
        elif kind == "like":
            cond = exact(lo).like(pattern.lower())
        elif kind == "prefix":
            cond = F.startswith(u, F.lit(pattern.upper()))
        else:
            raise ValueError(f"unknown rule kind {kind!r}")
        expr = (F.when if expr is None else expr.when)(cond, F.lit(out))
    return c if expr is None else expr.otherwise(c)


def wide_name_input(c, patterns=NOISE_PATTERNS) -> Column:
    """Wide sources: drop '..', trim, blank -> NULL, noise -> NULL."""
    return null_noise(clean_text(c), patterns)


def long_name_input(c) -> Column:
    """Long sources: upper(trim(name)), blank -> NULL."""
    return F.nullif(F.trim(F.upper(_col(c))), F.lit(""))


def standardize_wide_name(c, rules) -> Column:
    return apply_rules(wide_name_input(c), rules)


def standardize_long_name(c, rules) -> Column:
    return apply_rules(long_name_input(c), rules)


def with_standard_names(df: DataFrame, outputs: dict, keep: list | None = None) -> DataFrame:
    """Add standardised-name columns with each rule input computed once per row.

    ``outputs`` maps an output column to ``(input Column, rules)``. An inner
    projection holds every distinct input and its upper / lower forms (a
    non-trivial expression used by many branches is not inlined into them),
    and the outer projection runs the rule ladders over those columns.
    """
    keep = list(df.columns) if keep is None else keep
    inner, refs = [], {}
    for i, (out, (expr, rules)) in enumerate(outputs.items()):
        base = f"_nm{i}"
        inner += [expr.alias(base), F.upper(expr).alias(base + "_u"), F.lower(expr).alias(base + "_l")]
        refs[out] = (base, rules)
    staged = df.select(*keep, *inner)
    return staged.select(*keep, *[
        apply_rules(F.col(b), rules, upper=F.col(b + "_u"), lower=F.col(b + "_l")).alias(out)
        for out, (b, rules) in refs.items()])
