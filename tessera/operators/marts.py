"""Marts on top of the star: yearly aggregates, year-over-year change, key figures over calendar years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.dims import Dimension
from tessera.operators.star import DimLink, broadcast_budget, side_bytes, star_join


def yearly_totals_wide(wide: DataFrame, row_links: list[DimLink], value_cols: list[str], cell_expr,
                       cell_link: DimLink) -> DataFrame:
    """Sum and count of the measure per dimension keys and year, of a fact that is not built: sums of every value
    column per natural key first, then the joins and the unpivot, on one row per
    key, and a last sum per surrogate key (unknown members share the key NULL).

    The source rows are shuffled as partial aggregates; no join sees them, so a
    member with a third of the rows costs one row per task.
    """
    natural = [c for link in row_links for c in link.on.values()]
    sums = (wide.groupBy(*natural)
                .agg(*[F.sum(c).alias(f"{c}_total") for c in value_cols],
                     *[F.count(c).alias(f"{c}_n") for c in value_cols]))
    keyed = star_join(sums, row_links, [f"{c}_{k}" for c in value_cols for k in ("total", "n")])
    cells = F.array(*[F.struct(F.lit(c).alias("cell"), F.col(f"{c}_total").cast("decimal(38,2)").alias("total"),
                               F.col(f"{c}_n").alias("n")) for c in value_cols])
    row_keys = [link.dim.key for link in row_links]
    long = keyed.select(*row_keys, F.inline(cells)).where("n > 0")
    (fact_col,) = cell_link.on.values()
    long = long.select(*row_keys, cell_expr(F.col("cell")).alias(fact_col), "total", "n")
    by = [*row_keys, cell_link.dim.key]
    return (star_join(long, [cell_link], [*row_keys, "total", "n"]).groupBy(*by)
            .agg(F.sum("total").alias("total"), F.sum("n").alias("n")))


def year_over_year(totals: DataFrame, by: list[str], year_col: str = "Year",
                   value_col: str = "total") -> DataFrame:
    """Change against the year before of the same series; null where that year is
    missing. ``year_col`` holds calendar years.

    The window partitions by series; after aggregation a series holds one
    row per year, so no window partition can grow with the data volume.
    """
    w = Window.partitionBy(*by).orderBy(year_col)
    prev = F.when(F.lag(year_col).over(w) == F.col(year_col) - 1, F.lag(value_col).over(w))
    return totals.select("*", prev.alias("previous"), (F.col(value_col) - prev).alias("change"))


def attach(fact: DataFrame, dim: Dimension, columns: list[str]) -> DataFrame:
    """Left-join dimension attributes onto a fact by surrogate key (checked broadcast)."""
    side = dim.df.select(dim.key, *columns)
    if side_bytes(dim, [dim.key, *columns]) <= broadcast_budget(fact.sparkSession):
        side = F.broadcast(side)
    return fact.join(side, dim.key, "left")


def rolled_up(totals: DataFrame, by: list[str], year_col: str = "Year") -> DataFrame:
    """Totals of every combination of ``by`` and of none, for each year: column ``level`` names the columns that a row is
    kept apart by (joined by ``+``; ``all`` for none), the others are NULL.

    One aggregate over grouping sets of rows that are sums already (``total``, ``n``).
    """
    sets = [[c for i, c in enumerate(by) if not mask >> i & 1] for mask in range(1 << len(by))]
    out = totals.groupingSets([[F.col(c) for c in (*s, year_col)] for s in sets], *[F.col(c) for c in by], F.col(year_col)).agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), *[F.grouping(c).alias(f"_g_{c}") for c in by])
    names = F.concat_ws("+", *[F.when(F.col(f"_g_{c}") == 0, F.lit(c)) for c in by])
    return out.select(F.when(names == "", "all").otherwise(names).alias("level"), *by, year_col, "total", "n")


def kpis(rolled: DataFrame, by: list[str], base_year: int, span: int = 3, year_col: str = "Year") -> DataFrame:
    """Key figures of every series (a level and its ``by``) and year of ``rolled_up`` totals.

    * ``moving_mean``: mean of the totals of this calendar year and the ``span - 1`` before it that have one (a RANGE
      frame: a gap in the years shortens the mean, it doesn't reach further back);
    * ``share``: part of the level's total of the year;
    * ``base_index``: 100 times the total over that of ``base_year``, NULL where the series has none or zero there;
    * ``to_date``: sum of the totals up to this year.

    After aggregation a series holds a row a year and a level's year a row a series; the share is a join with the
    level's sums, not a window, so that no task gets a whole year.
    """
    series = Window.partitionBy("level", *by)
    near = series.orderBy(year_col).rangeBetween(-(span - 1), 0)
    years = rolled.groupBy("level", year_col).agg(F.sum("total").alias("_year_total"))
    base = F.max(F.when(F.col(year_col) == base_year, F.col("total"))).over(series)
    number = lambda c: c.cast("double")
    out = rolled.select("*", F.sum("total").over(near).alias("_sum"), F.count("total").over(near).alias("_n"), base.alias("_base"),
                        F.sum("total").over(series.orderBy(year_col).rangeBetween(Window.unboundedPreceding, 0)).alias("to_date"))
    return out.join(years, ["level", year_col]).select(
        "level", *by, year_col, "total", "n", (number(F.col("_sum")) / F.col("_n")).alias("moving_mean"),
        F.when(F.col("_year_total") != 0, number(F.col("total")) / number(F.col("_year_total"))).alias("share"),
        F.when(F.col("_base") != 0, 100.0 * number(F.col("total")) / number(F.col("_base"))).alias("base_index"), "to_date")
