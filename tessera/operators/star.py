"""Star joins: facts to dimension keys by left equi-joins on natural keys.

Broadcasting is decided per dimension from its exact row count and the measured
bytes of its texts (both known from key assignment), against a byte budget. Below
the budget the dimension is broadcast (no shuffle of the fact); above it the keys of a
whole-number natural key come from a broadcast index of their ranks, where that is
below the budget; other joins are left to the planner and AQE (sort-merge, skew splitting, runtime
broadcast when the shuffled side turns out small).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import collated, exact
from tessera.operators.bitmap import with_rank
from tessera.operators.dims import Dimension
from tessera.operators.skew import HotKeys, row_bucket, salted

DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Bytes of one value; a text value adds its measured bytes.
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
          T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.TimestampType: 8, T.DecimalType: 16,
          T.StringType: 16}


def side_bytes(dim: Dimension, columns: list[str]) -> int:
    """Upper-end size in memory of these columns of a dimension: rows x (values + row
    overhead) and twice the bytes of its texts (a join key may be upper-cased)."""
    types = [dim.df.schema[c].dataType for c in columns]
    width = sum(_WIDTH.get(type(t), 32) for t in types) + 16
    text = sum(dim.string_bytes[c] for c, t in zip(columns, types) if isinstance(t, T.StringType))
    return dim.rows * width + 2 * text


def broadcast_budget(spark) -> int:
    conf = spark.conf.get("tessera.broadcast.maxBytes", None)
    return int(conf) if conf else DEFAULT_BROADCAST_BYTES


@dataclass
class DimLink:
    """How a fact reaches one dimension.

    ``on`` maps the dimension's natural-key columns to fact expressions.
    Text columns compare under the collation, without regard to case and trailing
    blanks (Spark hashes or sorts their collation keys: still an equi-join);
    ``collated`` names those that do where others compare exactly.
    ``salt_buckets`` > 1 turns on salting for a single-column join that does
    not broadcast: fact rows whose key is in ``hot_keys`` (or NULL) are spread
    over that many buckets, and the matching dimension rows are replicated
    into every bucket. ``hot_keys=None`` finds them with ``find_hot_keys``.
    ``hot``, by fact column, are heavy hitters that were measured when the fact's
    sources were written: a join that does not broadcast spreads those of the
    first column that has some, without being told to.
    ``attributes`` are dimension columns that the joined rows carry with the key.
    """
    dim: Dimension
    on: dict
    collated: tuple | None = None
    salt_buckets: int = 1
    hot_keys: list | None = None
    hot_support: float = 0.05
    attributes: tuple = ()
    hot: dict[str, HotKeys] = field(default_factory=dict)


def find_hot_keys(df: DataFrame, column: str, support: float = 0.05) -> list:
    """Values that may hold at least ``support`` of the rows (one distributed
    pass, ``DataFrame.stat.freqItems``; at most about 1/support candidates,
    false positives possible, which only cost a little replication)."""
    row = df.select(column).stat.freqItems([column], support).collect()[0]
    return [v for v in row[0] if v is not None]


def _salted(fact: DataFrame, side: DataFrame, name: str, link: DimLink, i: int):
    """Add a salt column to both sides: hot / NULL fact keys get a bucket by the
    hash of their row, hot dimension rows are exploded into every bucket."""
    hot = link.hot_keys if link.hot_keys is not None else find_hot_keys(fact, name, link.hot_support)
    salt = f"_salt{i}"
    b = link.salt_buckets
    key = F.col(name)
    hot_fact = key.isNull() | key.isin(hot) if hot else key.isNull()
    fact = fact.withColumn(salt, F.when(hot_fact, row_bucket(fact, F.lit(b))).otherwise(F.lit(0)))
    buckets = F.when(F.col(name).isin(hot), F.sequence(F.lit(0), F.lit(b - 1))) if hot else None
    side = side.withColumn(salt, F.explode(buckets.otherwise(F.array(F.lit(0))))) if hot \
        else side.withColumn(salt, F.lit(0))
    return fact, side, salt


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _by_rank(link: DimLink, fact: DataFrame, names: list[str], budget: int) -> bool:
    """Whether the dimension's keys can be had from an index within the budget instead of a shuffled join."""
    plain = list(link.on) == link.dim.natural_key and not link.attributes and link.salt_buckets == 1
    return plain and fact.schema[names[0]].dataType.typeName() in ("integer", "long") and link.dim.ranked(budget) is not None


def star_join(fact: DataFrame, links: list[DimLink], keep: list[str],
              how: str = "left", max_broadcast_bytes: int | None = None) -> DataFrame:
    budget = max_broadcast_bytes if max_broadcast_bytes is not None else broadcast_budget(fact.sparkSession)
    out = fact
    for i, link in enumerate(links):
        dim_cols, fact_cols, names = [], [], []
        for j, (dcol, fexpr) in enumerate(link.on.items()):
            name = f"_jk{i}_{j}"
            d, f = F.col(dcol), _col(fexpr)
            if isinstance(link.dim.df.schema[dcol].dataType, T.StringType):
                as_compared = collated if link.collated is None or dcol in link.collated else exact
                d, f = as_compared(d), as_compared(f)
            dim_cols.append(d.alias(name))
            fact_cols.append(f.alias(name))
            names.append(name)
        side = link.dim.df.select(F.col(link.dim.key), *link.attributes, *dim_cols)
        out = out.select("*", *fact_cols)
        join_on = list(names)
        if side_bytes(link.dim, [link.dim.key, *link.attributes, *link.on]) <= budget:
            side = F.broadcast(side)
        elif how == "left" and _by_rank(link, out, names, budget):
            out = with_rank(out, names[0], link.dim.ranked(budget), link.dim.key).drop(*names)
            continue
        elif link.salt_buckets > 1 and len(names) == 1:
            out, side, salt = _salted(out, side, names[0], link, i)
            join_on.append(salt)
        else:
            for name, fexpr in zip(names, link.on.values()):
                known = link.hot.get(fexpr) if isinstance(fexpr, str) else None
                spread = known.buckets(_partitions(fact)) if known else {}
                if spread:
                    out, side = salted(out, side, name, spread, f"_salt{i}")
                    join_on.append(f"_salt{i}")
                    break
        out = out.join(side, on=join_on, how=how).drop(*join_on)
    return out.select(*_joined(links), *keep)


def _joined(links: list[DimLink]) -> list[str]:
    """Columns that the links add to a fact."""
    return [c for link in links for c in (link.dim.key, *link.attributes)]


def build_fact(long: DataFrame, links: list[DimLink], measure: str = "Value",
               keep_extra: list[str] = (), drop_null_measure: bool = True,
               max_broadcast_bytes: int | None = None) -> DataFrame:
    """Fact rows: optional not-null measure filter (first, so it prunes before
    the joins), then the star left joins; keys first, then extras and measure."""
    if drop_null_measure:
        long = long.filter(F.col(measure).isNotNull())
    return star_join(long, links, list(keep_extra) + [measure],
                     max_broadcast_bytes=max_broadcast_bytes)


def unpivot_fact(wide: DataFrame, row_links: list[DimLink], value_cols: list[str],
                 cell_expr, cell_col: str, cell_links: list[DimLink], key_order: list[str],
                 measure: str = "Value", keep_extra: list[str] = (),
                 drop_null_measure: bool = True,
                 max_broadcast_bytes: int | None = None) -> DataFrame:
    """Fact rows from a wide source: row-level keys before the unpivot, cell-level after.

    Keys that depend only on the wide row (member, indicator, unit) are
    resolved once per row; only the key that depends on the unpivoted column
    (the year, or the measure name) is resolved per cell. For 28 year
    columns that is 28x fewer probes (and, for a dimension too large to
    broadcast, 28x fewer rows shuffled) than joining after the unpivot.
    ``cell_expr`` maps the unpivoted column-name column to ``cell_col``.
    """
    keyed = star_join(wide, row_links, list(keep_extra) + list(value_cols),
                      max_broadcast_bytes=max_broadcast_bytes)
    row_keys = _joined(row_links)
    long = keyed.unpivot(row_keys + list(keep_extra), list(value_cols), "_cell", measure)
    long = long.select(*row_keys, *keep_extra, cell_expr(F.col("_cell")).alias(cell_col), measure)
    if drop_null_measure:
        long = long.filter(F.col(measure).isNotNull())
    out = star_join(long, cell_links, row_keys + list(keep_extra) + [measure],
                    max_broadcast_bytes=max_broadcast_bytes)
    return out.select(*key_order, *keep_extra, measure)
