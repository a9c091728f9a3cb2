"""The data-quality checks run over a loaded warehouse, parameterised by table.

The source's checks are hand-run queries whose table name is edited before
each run; here one call runs every check on every table it applies to and
returns the violating rows per check plus one summary row per check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators import skew
from tessera.operators.dims import Dimension
from tessera.operators.keys import size_aggregates
from tessera.plans.gold import ALIAS_TABLES, FACT_NAMES
from tessera.specs import TABLES

# natural key of one clean row: a wide row is one (country, indicator[, series])
WIDE_KEY = ["Country_code", "Indicator_code", "Units"]
LONG_KEY = ["Country_code", "Time_Period", "SeriesDescription", "Units"]

DIMS = {"dim_country": ("Country_key", ["Country_id"]),
        "dim_indicator": ("Indicator_key", ["Indicator_id", "Source_Table"]),
        "dim_year": ("Year_key", ["Year"]),
        "dim_unit_of_measure": ("Units_key", ["Measure_Units"])}


def _exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def load_dimension(spark: SparkSession, name: str, prefix: str = "") -> Dimension:
    key, nk = DIMS[name]
    df = spark.table(f"{prefix}gold.{name}")
    size = df.agg(*size_aggregates(df)).first().asDict()
    return Dimension(name, df, key, nk, size.pop("n"), {c: b or 0 for c, b in size.items()})


def quality_checks(spark: SparkSession, tables=TABLES, conflict_pair=("domestic_accommodation", "sdg_12b1"),
                   prefix: str = "") -> dict[str, tuple[str, DataFrame]]:
    """check name -> (table, violating rows) for every table present."""
    checks: dict[str, tuple[str, DataFrame]] = {}
    for spec in tables:
        name = f"{prefix}silver.{spec.stem}"
        if not _exists(spark, name):
            continue
        df = spark.table(name)
        key = list(WIDE_KEY) + (["Series_method"] if spec.with_series else []) \
            if spec.shape == "wide" else list(LONG_KEY)
        checks[f"duplicates:{spec.stem}"] = (name, Q.duplicates(df.filter(F.col("Country_code").isNotNull()), key))
        checks[f"blanks:{spec.stem}"] = (name, Q.untrimmed_rows(df))
        checks[f"charset:{spec.stem}"] = (name, Q.nonstandard_values(df, "Country"))
        # the source's own form of the duplicate check and its standardisation profile: lists to read, not faults
        checks[f"repeated_country:{spec.stem}"] = (name, Q.duplicates(df, ["Country"]))
        checks[f"profile:{spec.stem}"] = (name, Q.distinct_values(df, "Country"))
    left, right = conflict_pair
    if _exists(spark, f"{prefix}silver.{left}") and _exists(spark, f"{prefix}silver.{right}"):
        checks[f"id_conflict:{left}~{right}"] = (f"{prefix}silver.{left}", Q.id_conflicts(
            spark.table(f"{prefix}silver.{left}"), spark.table(f"{prefix}silver.{right}"), "Country_code", "Country"))
    # after a load: ids that the clean tables know under several names (the star keeps one of them)
    for name in ALIAS_TABLES:
        table = f"{prefix}gold.{name}"
        if _exists(spark, table):
            checks[f"id_conflict:{name}"] = (table, spark.table(table))
    if all(_exists(spark, f"{prefix}gold.{d}") for d in DIMS):
        dims = {d: load_dimension(spark, d, prefix) for d in DIMS}
        for d in dims.values():
            checks[f"dim_unique:{d.name}"] = (f"{prefix}gold.{d.name}", Q.dim_key_unique(d))
        for fact in FACT_NAMES.values():
            if not _exists(spark, f"{prefix}gold.{fact}"):
                continue
            used = [dims[d] for d in DIMS if d != "dim_indicator" or fact != "fact_sdg"]
            table = f"{prefix}gold.{fact}"
            checks[f"fk:{fact}"] = (table, Q.fk_violations(spark.table(table), used, hot=skew.stored(spark, table)))
    return checks


def quality_report(spark: SparkSession, tables=TABLES, prefix: str = "") -> tuple[DataFrame, dict]:
    checks = quality_checks(spark, tables, prefix=prefix)
    return Q.summarize(checks), checks
