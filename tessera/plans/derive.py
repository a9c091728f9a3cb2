"""Raw statistics files derived from the driver tables.

The warehouse's real inputs are fourteen ';'-separated text extracts. To run
the whole raw -> clean -> star load at any scale, Spark derives extracts of
the same layouts from the driver tables and writes them as text:

* wide tables: ``lineitem`` revenue per (supplier, line number, return flag),
  one text cell per ship year with thousands separators and '..' for empty
  cells, codes and names in the raw spellings the cleaning rules expect;
* long (SDG) tables: ``orders`` value per (customer, order year).

Every line of the extracts comes from an aggregate of the driver tables, so
their size grows with the data; nothing is sampled, and every ship year has
its column (``raw_slot``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.driver import NAME_VOCABULARY, load
from tessera.session import keep_methods_compiled, run_concurrently, scratch_path
from tessera.specs import RAW_YEARS, SERIES_RULES, TABLES, TableSpec, raw_slot, year_col

#: Series description of each long table, in the order of the series rules (a prefix is completed).
SERIES_TEXT = {t.stem: text if kind == "eq" else f"{text}number of tables)"
               for t, (kind, text, _) in zip((t for t in TABLES if t.shape == "long"), SERIES_RULES)}


def _vocab(key: Column) -> Column:
    vocab = F.array(*[F.lit(v) for v in NAME_VOCABULARY])
    return F.element_at(vocab, (key % len(NAME_VOCABULARY)).cast("int") + 1)


def _cell(v: Column) -> Column:
    """DECIMAL -> raw text cell: thousands separators, '..' when not reported."""
    return F.coalesce(F.format_number(v, 2), F.lit(".."))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lineitem_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per (supplier, line number, return flag) and ship year as text cells, materialised once
    (Parquet in the scratch folder) because eleven extracts read it: a cell is formatted once.

    Sums per (keys, year) first: one decimal add per input row. They are then brought together by
    keys as they are, a number a row, and laid out in 27 columns only where a key's rows already lie
    in one partition (``pivot`` lays each out before it is shuffled: 27 columns for one number).
    """
    li = load(spark, sf_dir, "lineitem")
    keys = ["l_suppkey", "l_linenumber", "l_returnflag"]
    sums = (li.select(*keys, raw_slot(F.year("l_shipdate")).alias("yr"),
                      F.col("l_extendedprice").cast("decimal(18,2)").alias("p"))
              .groupBy(*keys, "yr").agg(F.sum("p").alias("v")))
    cube = sums.repartition(*keys).groupBy(*keys).agg(*[F.max(F.when(F.col("yr") == yr, F.col("v"))).alias(year_col(yr)) for yr in RAW_YEARS])
    return _stored(cube.select(*keys, *[_cell(F.col(year_col(yr)).cast("decimal(38,2)")).alias(year_col(yr)) for yr in RAW_YEARS]), "cube")


def wide_extract(cube: DataFrame, spec: TableSpec, index: int) -> DataFrame:
    """Raw wide layout (all text) for one table spec."""
    ln = F.col("l_linenumber")
    digit = F.lit(str(index % 2 + 1))
    code = F.when(F.col("l_returnflag") == "A", F.concat(digit, F.lit(","), ln.cast("string"))) \
            .otherwise(F.concat(digit, ln.cast("string")))
    c = F.when(F.col("l_suppkey") % 97 == 0, F.lit(" ")).otherwise(F.col("l_suppkey").cast("string"))
    units = (F.when(F.col("l_returnflag") == "R", F.lit("Units"))
              .when(F.col("l_returnflag") == "A", F.lit("Nights"))
              .otherwise(F.lit("Thousands")))
    cols = [
        c.alias("C"), code.alias("S"), F.concat(c, F.lit("_"), code).alias("C_and_S"),
        _vocab(F.col("l_suppkey")).alias("Basic_data"),
        F.when(ln % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("Line "), ln.cast("string"))).alias("Unnamed_5"),
        F.concat(F.lit(" "), F.lower(F.col("l_returnflag")), F.lit(" flag")).alias("Unnamed_6"),
        F.lit("").alias("Unnamed_7"), F.lit(spec.tag.lower()).alias("Unnamed_8"),
        units.alias("Units"), F.lit("").alias("Notes"),
    ]
    if spec.with_series:
        cols.append(F.when(ln == 1, F.lit("..")).otherwise(F.lit(" TF ")).alias("Series"))
    cols += [F.col(year_col(y)) for y in RAW_YEARS]
    cols.append(F.lit("").alias("Unnamed_39" if spec.with_series else "Unnamed_38"))
    return cube.select(*cols)


def orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per (customer, order year), materialised once (Parquet in the
    scratch folder) because the three SDG extracts read it."""
    orders = load(spark, sf_dir, "orders")
    return _stored(orders.groupBy("o_custkey", F.year("o_orderdate").alias("yr"))
                         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("v")), "orders-by-year")


def long_extract(agg: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw SDG layout: value per (customer, order year) as text."""
    k = F.col("o_custkey")
    value = (F.when(k % 13 == 0, F.format_number("v", 2))       # '1,234.50': NULL, as coded
              .when(k % 17 == 0, F.lit(".."))
              .otherwise(F.col("v").cast("string")))
    units = F.when(k % 3 == 0, F.lit("NUMBER")).otherwise(F.lit("PERCENT"))
    return agg.select(
        F.lit("").alias("Idex"), F.lit(spec.stem[3:]).alias("SDG_Indicator"),
        F.lit("ST_" + spec.stem.upper()).alias("SeriesCode"),
        F.lit(SERIES_TEXT[spec.stem]).alias("SeriesDescription"),
        k.cast("string").alias("GeoAreaCode"), _vocab(k).alias("GeoAreaName"),
        F.col("yr").cast("string").alias("TimePeriod"), value.alias("Value"),
        F.lit("Derived").alias("Source"), F.lit("").alias("FootNote"),
        F.lit("C ").alias("Nature"), units.alias("Units"),
    )


def write_extract(df: DataFrame, path: str) -> None:
    """';'-separated text with a header line per part file; no quoting, empty
    strings written as nothing (what a plain text export looks like)."""
    (df.write.mode("errorifexists")
       .option("sep", ";").option("header", True)
       .option("quote", "\u0000").option("escapeQuotes", False)
       .option("emptyValue", "").option("nullValue", "")
       .csv(path))


def derive_raw_files(spark: SparkSession, sf_dir: str, out_dir: str, tables=TABLES,
                     parallelism: int = 4) -> dict[str, str]:
    """Write one extract directory per table spec (independent jobs, run from a
    small thread pool); returns stem -> path."""
    keep_methods_compiled(spark)
    bases = run_concurrently(spark, {
        "wide": lambda: lineitem_cube(spark, sf_dir) if any(t.shape == "wide" for t in tables) else None,
        "long": lambda: orders_by_year(spark, sf_dir) if any(t.shape == "long" for t in tables) else None,
    })
    paths = {t.stem: f"{out_dir.rstrip('/')}/{t.stem}" for t in tables}

    def one(i, spec):
        df = wide_extract(bases["wide"], spec, i) if spec.shape == "wide" else long_extract(bases["long"], spec)
        write_extract(df, paths[spec.stem])

    run_concurrently(spark, {spec.stem: (lambda i=i, s=spec: one(i, s)) for i, spec in enumerate(tables)},
                     parallelism)
    return paths
