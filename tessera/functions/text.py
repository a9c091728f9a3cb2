"""Text cleaning rules as Column -> Column functions (all built-in expressions)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.specs import COLLATION, NOISE_PATTERNS

PLACEHOLDER = ".."


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collated(c) -> Column:
    """The value as text that compares without regard to case and trailing blanks.

    Joins on it hash or sort a collation key that Spark computes once a row;
    grouping by it sorts, so copies of one spelling should be merged before.
    """
    return F.collate(_col(c), COLLATION)


def exact(c) -> Column:
    """The value as text that compares code point by code point."""
    return F.collate(_col(c), "UTF8_BINARY")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def blank_to_null(c) -> Column:
    """``NULLIF(TRIM(c), '')``: trims U+0020 only, like the source."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def drop_token(c, token: str = PLACEHOLDER) -> Column:
    return F.replace(_col(c), F.lit(token), F.lit(""))


def clean_text(c, placeholder: str | None = PLACEHOLDER) -> Column:
    """Placeholder-to-null text clean: drop the placeholder, trim, '' -> NULL."""
    c = _col(c)
    if placeholder is not None:
        c = drop_token(c, placeholder)
    return blank_to_null(c)


def matches_any(c, patterns) -> Column:
    """Case-insensitive LIKE against any of the patterns."""
    c = exact(c)
    return reduce(or_, [c.ilike(p) for p in patterns])


def noise_patterns(quote: str | None = "") -> tuple:
    """Noise patterns for a scan mode. With ``"`` as text qualifier the reader
    strips the quote that starts the header note, so its pattern is also
    matched without the quote."""
    if quote == '"':
        return NOISE_PATTERNS + tuple(p[1:] for p in NOISE_PATTERNS if p.startswith('"'))
    return NOISE_PATTERNS


def null_noise(c, patterns=NOISE_PATTERNS) -> Column:
    """Header / footnote rows keep their row but lose the value."""
    c = _col(c)
    return F.when(matches_any(c, patterns), F.lit(None).cast("string")).otherwise(c)


def collation_key(c) -> Column:
    """Plain text that is equal where values are equal but for case and trailing blanks:
    for systems without collations, and to check joins by another way than their own."""
    return F.upper(F.rtrim(exact(c)))


def group_collated(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """``df.groupBy(keys).agg(aggregates)`` with text keys compared under the collation.
    The least spelling of a group's keys stands for it, in the type its column has."""
    text = [k for k in text_columns(df) if k in keys]
    named = [(collated(k) if k in text else F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    out = df.groupBy(*named).agg(*[F.min(exact(k)).alias(f"_s{keys.index(k)}") for k in text], *aggregates)
    shown = [F.col(f"_s{i}").cast(df.schema[k].dataType).alias(k) if k in text else F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]
    return out.select(*shown, *out.columns[len(keys) + len(text):])


def as_exact(df: DataFrame) -> DataFrame:
    """The same rows with text that compares code point by code point (aggregates then hash)."""
    text = text_columns(df)
    return df.select(*[exact(c).alias(c) if c in text else F.col(c) for c in df.columns])


def distinct_collated(df: DataFrame) -> DataFrame:
    """Distinct rows whose text columns compare under the collation; of several
    spellings the least stays. Columns keep their types.

    Copies of one spelling go first, by a hash aggregate before the shuffle, so
    that only distinct spellings reach the sort by collation.
    """
    if not text_columns(df):
        return df.distinct()
    out = group_collated(as_exact(df).distinct(), df.columns)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def collated_equal(a, b) -> Column:
    return collated(a) == collated(b)


def untrimmed(c) -> Column:
    """True where the value differs from its trimmed form (NULL stays NULL)."""
    c = exact(c)
    return c != F.trim(c)


STANDARD_CHARS = r"[^a-zA-Z0-9 _-]"


def has_nonstandard_char(c, pattern: str = STANDARD_CHARS) -> Column:
    """Binary (code-point) test for any character outside the allowed class."""
    return exact(c).rlike(pattern)


def any_of(conditions) -> Column:
    """OR of conditions, NULL-safe: a NULL test counts as false."""
    return reduce(or_, [F.coalesce(c, F.lit(False)) for c in conditions])
