"""Column profiles that add up: sketch states kept per load, merged over loads.

A profile has a row a column: rows, NULLs, and two sketch states, one for the number
of distinct values (HyperLogLog of ``2 ** LG_K`` registers) and one for the most
frequent ones. States of different loads merge to the state of all their rows,
so the profile of a table that grows load by load, or of several tables
together, never reads old rows again. Values are compared as the clean layer
compares text.

Bounds: a distinct count is off by more than ``ERROR`` of itself in fewer than 3 of
1,000 cases (three standard errors); a value is among the most frequent ones if it
holds more than one row in ``FOUND``, and its count is off by at most as much. With
fewer than ``FOUND`` distinct values counts are exact.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import collation_key
from tessera.operators.skew import FOUND, TOP, TRACKED

LG_K = 14
ERROR = 3 * 1.04 / (1 << LG_K // 2)
SCHEMA = ("column_name string, rows long, nulls long, distinct_state binary, "
          "top_state struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>")


def _compared(df: DataFrame, c: str):
    """A column's value as text that is equal where values are equal."""
    own = F.col(f"`{c}`")
    return collation_key(own) if isinstance(df.schema[c].dataType, T.StringType) else own.cast("string")


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The profile of some columns (all of plain types), in one pass: a row a column, with sketch states."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))]
    columns = plain if columns is None else columns
    values = df.select(*[_compared(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    states = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(columns)):
        states += [F.count(f"v{i}").alias(f"n{i}"), F.hll_sketch_agg(f"v{i}", LG_K).alias(f"d{i}"), F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED})").alias(f"t{i}")]
    found = values.agg(*states)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("rows"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                     F.col(f"d{i}").alias("distinct_state"), F.col(f"t{i}").alias("top_state")) for i, c in enumerate(columns)]
    return found.select(F.inline(F.array(*rows)))


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/profiles"


def keep_profile(profiled: DataFrame, root: str, table: str, load_id: str) -> None:
    """Store the profile of a load; the same load again replaces it."""
    for name in (table, load_id):
        if not re.fullmatch(r"[A-Za-z0-9._-]+", name):
            raise ValueError(f"{name!r} must be letters, digits, dots, dashes and underscores")
    profiled.coalesce(1).write.mode("overwrite").parquet(f"{_folder(root)}/table_name={table}/load_id={load_id}")


def kept_profiles(spark: SparkSession, root: str) -> DataFrame:
    """All profiles kept under a root: table_name, load_id and the columns of a profile."""
    return spark.read.schema(f"{SCHEMA}, table_name string, load_id string").parquet(_folder(root))


def merged(profiles: DataFrame, by: list[str] = ("table_name", "column_name"), top: int = TOP) -> DataFrame:
    """Profiles of several loads as one: rows, NULLs, distinct values, and the most frequent values with their counts."""
    counts = profiles.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
                                       F.hll_sketch_estimate(F.hll_union_agg("distinct_state", F.lit(True))).alias("distinct"))
    # a state without values doesn't combine with others
    tops = profiles.where("nulls < rows").groupBy(*by).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(top_state, {TRACKED}), {top})").alias("top"))
    items = F.transform(F.filter("top", lambda x: x["item"].isNotNull()), lambda x: F.struct(x["item"].alias("value"), x["count"].alias("rows")))
    return counts.join(tops, list(by), "left").select(*by, "rows", "nulls", "distinct", F.coalesce(items, F.array().cast("array<struct<value:string,rows:bigint>>")).alias("top"))


__all__ = ["ERROR", "FOUND", "keep_profile", "kept_profiles", "merged", "profile"]
