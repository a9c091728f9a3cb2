"""Dimensions: union the sources, conform, distinct, drop incomplete rows, key.

Each builder returns a :class:`Dimension` whose DataFrame is materialised in
the checkpoint folder, so every fact that joins it sees the same keys and the
sources are not rescanned per fact. ``rows`` and ``string_bytes`` are exact
(they fall out of the key assignment); the star join decides on broadcasting by them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.conform import conform_units, first_label, qualify_label
from tessera.functions.dates import year_from_name
from tessera.functions.text import as_exact, collated, collated_equal, distinct_collated, exact, group_collated, text_columns
from tessera.operators.bitmap import key_ranks
from tessera.operators.keys import dense_key
from tessera.operators.reshape import schema_columns, union_all


@dataclass
class Dimension:
    name: str
    df: DataFrame
    key: str
    natural_key: list[str]
    rows: int
    string_bytes: dict = field(default_factory=dict)    # bytes of each text column, measured with the keys
    ranks: dict = field(default_factory=dict, compare=False)    # by budget: index of the keys (``bitmap.key_ranks``), None if it has none

    def ranked(self, budget: int) -> DataFrame | None:
        """Index of the keys by a whole-number natural key, built when first asked for."""
        if budget not in self.ranks:
            whole = len(self.natural_key) == 1 and self.df.schema[self.natural_key[0]].dataType.typeName() in ("integer", "long")
            self.ranks[budget] = key_ranks(self.df, self.natural_key[0], self.key, budget) if whole and budget else None
        return self.ranks[budget]


def build_dimension(name: str, df: DataFrame, key: str, natural_key: list[str],
                    order_by: list | None = None, *, dedupe: bool = True,
                    required: list[str] | None = None, method: str = "range") -> Dimension:
    """Generic dimension: drop rows missing ``required`` columns, distinct (text without
    regard to case and trailing blanks, the least spelling stays), key."""
    required = natural_key if required is None else required
    for c in required:
        df = df.filter(F.col(c).isNotNull())
    if dedupe:
        df = distinct_collated(df)
    text = text_columns(df)
    order_by = order_by or [exact(c) if c in text else F.col(c) for c in df.columns]
    keyed = dense_key(df, order_by, key, method=method, split_ties=not dedupe)
    return Dimension(name, keyed.df, key, natural_key, keyed.rows, keyed.string_bytes)


def least_name(df: DataFrame, natural_key: list[str], name_col: str) -> DataFrame:
    """One row per natural key (text keys under the collation): the least of its names.
    Facts that join on the natural key then keep their number of rows."""
    named = as_exact(df.where(F.col(name_col).isNotNull())).groupBy(*natural_key).agg(F.min(name_col).alias(name_col))
    one = group_collated(named, natural_key, F.min(name_col).alias(name_col))
    return one.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def aliases(df: DataFrame, natural_key: list[str], name_col: str) -> DataFrame:
    """The names of ``df`` that ``least_name`` leaves out (names that differ in case or trailing
    blanks only are one): natural key as kept, alias, kept name."""
    names = distinct_collated(df.select(*natural_key, name_col)).where(F.col(name_col).isNotNull())
    text = text_columns(df)
    keys = [f"_k{i}" for i in range(len(natural_key))]
    by = [(collated(k) if k in text else F.col(k)).alias(n) for k, n in zip(natural_key, keys)]
    kept = least_name(names, natural_key, name_col).select(*by, *natural_key, F.col(name_col).alias("kept_name"))
    return (names.select(*by, F.col(name_col).alias("alias")).join(kept, keys)
            .where(~collated_equal("alias", "kept_name")).select(*natural_key, "alias", "kept_name"))


def member_dim(sources: list[DataFrame], *, prefix: str = "Country", dedupe: bool = True,
               id_col: str = "id", name_col: str = "name", one_name: bool = False) -> Dimension:
    """(id, name) members from many sources; key ordered by id, then name.

    ``one_name`` keeps one row per id, with its least name.

    ``dedupe=False`` keeps one key per source row (the literal form; facts
    joining it multiply, and the key-uniqueness check reports it).
    """
    kid, kname = f"{prefix}_id", f"{prefix}_name"
    df = union_all([s.select(F.col(id_col).alias(kid), F.col(name_col).alias(kname))
                    for s in sources])
    if one_name:
        df = least_name(df, [kid], kname)
    return build_dimension(f"dim_{prefix.lower()}", df, f"{prefix}_key", [kid],
                           [kid, kname], dedupe=dedupe, required=[kid, kname])


def indicator_frame(df: DataFrame, tag: str, code_col: str = "Indicator_code",
                    levels=("Indicator_L1", "Indicator_L2", "Indicator_L3", "Indicator_L4")) -> DataFrame:
    """One source's (code, first non-null upper label, source tag)."""
    return df.select(F.col(code_col).alias("Indicator_code"),
                     first_label(*levels).alias("Indicator"),
                     F.lit(tag).alias("Source_Table"))


def indicator_dim(frames: list[DataFrame], *, join_on_source: bool = True, one_name: bool = False) -> Dimension:
    """Indicators from (Indicator_code, Indicator, Source_Table) frames.

    Labels are qualified by code, then made distinct; the key orders by id,
    then name and source so ties are deterministic. Facts join on
    (id, source) by default; ``join_on_source=False`` joins on the id only.
    ``one_name`` keeps one row per (id, source), with its least label.
    """
    u = union_all(frames)
    df = u.select(F.col("Indicator_code").alias("Indicator_id"),
                  qualify_label("Indicator_code", "Indicator").alias("Indicator_name"),
                  "Source_Table")
    return qualified_indicator_dim(df, join_on_source=join_on_source, one_name=one_name)


def qualified_indicator_dim(df: DataFrame, *, join_on_source: bool = True, one_name: bool = False) -> Dimension:
    """``indicator_dim`` of rows (Indicator_id, Indicator_name, Source_Table) whose labels are qualified already."""
    nk = ["Indicator_id", "Source_Table"] if join_on_source else ["Indicator_id"]
    if one_name:
        df = least_name(df, ["Indicator_id", "Source_Table"], "Indicator_name")
    return build_dimension("dim_indicator", df, "Indicator_key", nk,
                           ["Indicator_id", "Indicator_name", "Source_Table"],
                           required=["Indicator_id", "Indicator_name"])


def year_dim(year_frames: list[DataFrame], schema_sources: list[DataFrame] = (),
             *, dedupe: bool = True, year_col: str = "Year") -> Dimension:
    """Years from data columns plus years named in wide tables' column names.

    The year domain is bounded (1..9999), so after ``distinct`` the key can
    use the single-task window; without dedupe it stays on the range path.
    """
    parts = [f.select(F.col(year_col).cast("int").alias("Year")) for f in year_frames]
    for wide in schema_sources:
        parts.append(schema_columns(wide).select(year_from_name("column_name").cast("int").alias("Year")))
    df = union_all(parts)
    return build_dimension("dim_year", df, "Year_key", ["Year"], ["Year"], dedupe=dedupe,
                           method="window" if dedupe else "range")


def unit_dim(frames: list[DataFrame], unit_col: str = "Units") -> Dimension:
    """Units upper-cased and recoded, distinct, keyed by name."""
    df = union_all([f.select(conform_units(unit_col).alias("Measure_Units")) for f in frames])
    return build_dimension("dim_unit_of_measure", df, "Units_key", ["Measure_Units"],
                           ["Measure_Units"])


def build_concurrently(builders: dict, max_workers: int = 4) -> dict:
    """Run independent dimension builds as concurrent Spark jobs.

    Each build is a few short jobs (range sampling, checkpoint, partition
    counts); submitted together they share the executors instead of
    queueing one after another.
    """
    from pyspark.sql import SparkSession

    from tessera.session import run_concurrently

    return run_concurrently(SparkSession.active(), builders, max_workers)
