"""Reshaping: wide year columns to rows, tagged unions, schema widening."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def year_columns(df: DataFrame, prefix: str = "year_") -> list[str]:
    """Year columns in schema order (the wide layout's time axis)."""
    return [c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()]


def unpivot_years(df: DataFrame, ids: list[str], years: list[str] | None = None,
                  year_name: str = "Year", value_name: str = "Value",
                  drop_nulls: bool = False) -> DataFrame:
    """Wide year columns to (ids.., Year, Value) rows.

    ``DataFrame.unpivot`` plans a single ``Expand`` inside whole-stage codegen:
    one pass over the input, no shuffle. The year is the numeric suffix of
    the column name. ``drop_nulls`` keeps only filled cells.
    """
    years = years or year_columns(df)
    long = df.unpivot(ids, years, "_period", value_name)
    long = long.select(*ids, F.substring_index("_period", "_", -1).cast("int").alias(year_name),
                       value_name)
    if drop_nulls:
        long = long.filter(F.col(value_name).isNotNull())
    return long


def widen(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: missing columns become typed NULLs, order follows it."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """``UNION ALL`` by column name (no shuffle, no dedupe)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_tagged(frames: dict[str, DataFrame], tag_col: str = "Source_Table",
                 columns: list[str] | None = None, allow_missing: bool = False) -> DataFrame:
    """Union of several sources, each row tagged with its source name."""
    parts = []
    for tag, df in frames.items():
        if columns is not None:
            df = df.select(*columns)
        parts.append(df.withColumn(tag_col, F.lit(tag)))
    return union_all(parts, allow_missing)


def schema_columns(df: DataFrame, name_col: str = "column_name") -> DataFrame:
    """Schema metadata as a one-column DataFrame (the catalogue-as-source pattern).

    Bounded by the table's width, so creating it on the driver is safe.
    """
    spark = df.sparkSession
    return spark.createDataFrame([(n,) for n in df.columns], f"{name_col} string")
