"""Raw -> clean: one spec-driven projection per table (no shuffle, rows in = rows out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.codes import code_text, normalize_code, remap_area_code
from tessera.functions.dates import period_to_date
from tessera.functions.names import apply_rules, long_name_input, wide_name_input
from tessera.functions.numeric import parse_numeric_text, parse_plain_decimal, to_int
from tessera.functions.text import blank_to_null, clean_text, collated, exact, text_columns
from tessera.specs import CLEAN_LENGTH_LIMITS, CLEAN_YEARS, NOISE_PATTERNS, VALUE_TYPE, TableSpec, year_col

#: Raw labels of the wide layout by their clean names.
LABELS = {"Unnamed_5": "Indicator_L1", "Unnamed_6": "Indicator_L2", "Unnamed_7": "Indicator_L3", "Unnamed_8": "Indicator_L4", "Units": "Units"}


def clean_wide(raw: DataFrame, spec: TableSpec, noise_patterns=NOISE_PATTERNS) -> DataFrame:
    """Codes typed and normalised, names standardised, cells parsed to DECIMAL(18,2).

    The cleaned, noise-tested country and its upper / lower forms, the code's and the labels' trimmed texts are
    computed once in an inner projection and reused by every rule. The year cells are one
    array with one parser: a parser for each column makes a method too long to be compiled.
    Year columns missing from the raw layout become typed NULL columns.
    """
    country = wide_name_input("Basic_data", noise_patterns)
    have = [year_col(y) for y in CLEAN_YEARS if year_col(y) in raw.columns]
    cells = [F.transform(F.array(*have), lambda x: parse_numeric_text(x)).alias("_cells")] if have else []
    inner = raw.select("C", *(["Series"] if spec.with_series else []), *[F.trim(c).alias(c) for c in LABELS], *cells,
                       code_text("S").alias("_code"), country.alias("_country"), F.upper(country).alias("_country_u"),
                       F.lower(country).alias("_country_l"))
    cols = [
        to_int("C").alias("Country_code"),
        normalize_code("S", spec.code_fixes, text="_code").alias("Indicator_code"),
        apply_rules("_country", spec.name_rules, upper="_country_u", lower="_country_l").alias("Country"),
        *[F.nullif(F.col(c), F.lit("")).alias(name) for c, name in LABELS.items()],
    ]
    if spec.with_series:
        cols.append(clean_text("Series").alias("Series_method"))
    for y in CLEAN_YEARS:
        c = year_col(y)
        cols.append((F.get("_cells", F.lit(have.index(c))) if c in have else F.lit(None).cast(VALUE_TYPE)).alias(c))
    cols.append(F.current_timestamp().alias("dwh_create_date"))
    return inner.select(*cols)


def clean_long(raw: DataFrame, spec: TableSpec, *, strip_thousands: bool = False) -> DataFrame:
    """Area code remapped, name standardised, period to date, value parsed (as coded)."""
    name = long_name_input("GeoAreaName")
    inner = raw.select("*", name.alias("_country"), F.lower(name).alias("_country_l"))
    return inner.select(
        remap_area_code("GeoAreaCode", spec.code_remap).alias("Country_code"),
        apply_rules("_country", spec.name_rules, upper="_country", lower="_country_l").alias("Country"),
        period_to_date("TimePeriod").alias("Time_Period"),
        parse_plain_decimal("Value", strip_thousands=strip_thousands).alias("Value"),
        blank_to_null("SeriesDescription").alias("SeriesDescription"),
        blank_to_null("Nature").alias("Nature"),
        blank_to_null("Units").alias("Units"),
        F.current_timestamp().alias("dwh_create_date"),
    )


def over_long(df: DataFrame, spec: TableSpec):
    """Reject reason of a clean row: the first text column that is longer than declared (trailing blanks don't
    count, as they don't in comparisons), NULL if none is. Spark has no VARCHAR(n) with a collation, so the
    load enforces the lengths where it writes."""
    reason = F.lit(None).cast("string")
    for name, limit in reversed(CLEAN_LENGTH_LIMITS[spec.shape].items()):
        if name in df.columns:
            reason = F.when(F.length(F.rtrim(exact(name))) > limit, F.lit(f"too_long:{name}")).otherwise(reason)
    return reason


def clean_table(raw: DataFrame, spec: TableSpec, noise_patterns=NOISE_PATTERNS) -> DataFrame:
    """The clean table of a spec; its text columns have the type that compares under the collation."""
    df = clean_long(raw, spec) if spec.shape == "long" else clean_wide(raw, spec, noise_patterns)
    text = text_columns(df)
    return df.select(*[collated(c).alias(c) if c in text else F.col(c) for c in df.columns])
