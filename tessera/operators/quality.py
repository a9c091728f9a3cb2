"""Data-quality checks. Each returns the violating rows; empty means pass.

``summarize`` turns a set of checks into one row per check (name, table,
violations) without collecting any violating row to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import (
    any_of, as_exact, collated_equal, distinct_collated, group_collated, has_nonstandard_char, text_columns, untrimmed,
)
from tessera.operators.bitmap import key_bitmap, with_membership
from tessera.operators.dims import Dimension
from tessera.operators.skew import row_bucket, salted

#: Reducers over which a foreign-key check spreads the rows of NULL key.
NULL_BUCKETS = 4096


def duplicates(df: DataFrame, keys: list[str], count_col: str = "n") -> DataFrame:
    """Keys occurring more than once (GROUP BY .. HAVING COUNT(*) > 1); text keys
    compare under the collation, the least spelling is shown.

    Partial counts per partition before the shuffle; a hot key costs one
    counter per map task, not its rows. Spellings are merged after that.
    """
    counts = as_exact(df.select(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    if text_columns(counts):
        counts = group_collated(counts, keys, F.sum(count_col).alias(count_col))
    return counts.filter(F.col(count_col) > 1)


def untrimmed_rows(df: DataFrame, columns: list[str] | None = None,
                   flag_col: str | None = "untrimmed_columns") -> DataFrame:
    """Rows where any text column differs from its trimmed form.

    With ``flag_col`` the names of the offending columns are listed too.
    """
    columns = columns or text_columns(df)
    bad = df.filter(any_of([untrimmed(c) for c in columns]))
    if flag_col:
        bad = bad.withColumn(flag_col, F.concat_ws(",", *[
            F.when(F.coalesce(untrimmed(c), F.lit(False)), F.lit(c)) for c in columns]))
    return bad


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Standardisation profile: the distinct values of one column under the collation (the least spelling)."""
    return distinct_collated(df.select(column))


def nonstandard_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values holding a character outside [a-zA-Z0-9 _-]."""
    return distinct_collated(df.select(column).filter(has_nonstandard_char(column)))


def id_conflicts(left: DataFrame, right: DataFrame, id_col: str, name_col: str, *,
                 left_name: str = "Accommodation", right_name: str = "SDG",
                 left_col: str = "Country_Acc", right_col: str = "Country_SDG",
                 only_conflicts: bool = True) -> DataFrame:
    """Cross-source id/name mapping report.

    Both sides are reduced to distinct (id, name) first (spellings that differ
    in case or trailing blanks are one name; the partial aggregate runs before
    the shuffle, so a hot id costs one row per map task); then a full outer join classifies each pair as
    ``Missing_in_<left>``, ``Missing_in_<right>``, ``Country_Conflict`` or
    ``OK``. Names compare case- and trailing-blank-insensitively.
    ``only_conflicts`` plans an inner join instead (conflicts need both sides).
    Copies never pair up: an id held by a third of all rows contributes one
    row per distinct name on each side, and the pairs formed are exactly the
    (name, name) pairs the report lists for that id.
    """
    a = distinct_collated(left.select(F.col(id_col).alias("_id_l"), F.col(name_col).alias(left_col)))
    b = distinct_collated(right.select(F.col(id_col).alias("_id_r"), F.col(name_col).alias(right_col)))
    ln, rn = F.col(left_col), F.col(right_col)
    how = "inner" if only_conflicts else "full"
    j = a.join(b, F.col("_id_l") == F.col("_id_r"), how)
    status = (F.when(F.col("_id_l").isNull(), F.lit(f"Missing_in_{left_name}"))
               .when(F.col("_id_r").isNull(), F.lit(f"Missing_in_{right_name}"))
               .when(~collated_equal(ln, rn), F.lit("Country_Conflict"))
               .otherwise(F.lit("OK")))
    out = j.select(F.coalesce("_id_l", "_id_r").alias("ID"), ln, rn, status.alias("Status"))
    if only_conflicts:
        out = out.filter((F.col("Status") == "Country_Conflict") & ln.isNotNull())
    return out


def fk_violations(fact: DataFrame, dims: list[Dimension], fact_keys: list[str] | None = None,
                  failed_col: str = "failed_keys", with_dimensions: bool = False, method: str = "auto",
                  hot: dict | None = None) -> DataFrame:
    """Fact rows whose key does not resolve in its dimension (left join + null test).

    Dimension keys are unique, so the joins cannot fan out. The result keeps the
    fact columns and names the keys that failed. A side under the broadcast budget
    is broadcast. Above it, whole-number keys are looked up in a bitmap index of the
    dimension (``bitmap.key_bitmap``), broadcast if its measured size is under the
    budget, so the fact stays where it is. What remains is a shuffled join, in which
    ``hot`` (by fact key, measured when the fact was written) spreads heavy keys and
    NULL keys; without it NULL keys, which match nothing, are spread as
    negative numbers (dimension keys are 1..N), not sent to one reducer.
    ``method``: ``bitmap`` or ``join`` instead of that choice.

    ``with_dimensions`` also carries every dimension column, prefixed ``<dimension>__`` (the
    star projection over all joined relations, with names that stay unique and writable).
    """
    from tessera.operators.star import broadcast_budget, side_bytes

    if method not in ("auto", "bitmap", "join") or method == "bitmap" and with_dimensions:
        raise ValueError(f"method {method!r}" + " has no dimension columns" * with_dimensions)
    fact_keys = fact_keys or [d.key for d in dims]
    budget = broadcast_budget(fact.sparkSession)
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = fact
    flags = []
    for i, (d, fk) in enumerate(zip(dims, fact_keys)):
        small = side_bytes(d, d.df.columns if with_dimensions else [d.key]) <= budget
        whole = fact.schema[fk].dataType.typeName() in ("integer", "long")
        if whole and not with_dimensions and (method == "bitmap" or method == "auto" and not small):
            index = key_bitmap(d.df, d.key)
            if method == "bitmap" or index.bytes <= budget:
                out = with_membership(out, fk, index, f"_hit{i}")
                flags.append((fk, ~F.col(f"_hit{i}")))
                continue
        extra = [F.col(c).alias(f"{d.name}__{c}") for c in d.df.columns] if with_dimensions else []
        name = f"_dk{i}"
        side = d.df.select(F.col(d.key).alias(name), F.lit(True).alias(f"_hit{i}"), *extra)
        key = F.col(fk)
        spread = hot[fk].buckets(partitions) if hot and fk in hot else {}
        if small:
            side = F.broadcast(side)
        elif spread:
            out, side = salted(out.withColumn(name, key), side, name, spread, f"_salt{i}")
            out = out.join(side, [name, f"_salt{i}"], "left").drop(name, f"_salt{i}")
            flags.append((fk, F.col(f"_hit{i}").isNull()))
            continue
        elif whole:
            key = F.coalesce(key, -1 - row_bucket(fact, F.lit(NULL_BUCKETS)))
        out = out.join(side, key == F.col(name), "left").drop(name)
        flags.append((fk, F.col(f"_hit{i}").isNull()))
    bad = out.filter(reduce(lambda a, b: a | b, [f for _, f in flags]))
    bad = bad.withColumn(failed_col, F.concat_ws(",", *[F.when(f, F.lit(k)) for k, f in flags]))
    return bad.drop(*[f"_hit{i}" for i in range(len(dims))])


def dim_key_unique(dim: Dimension) -> DataFrame:
    """Natural keys that map to more than one dimension row (fan-out guard)."""
    return duplicates(dim.df, dim.natural_key)


def summarize(checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """One row per check: (check, table, violations). Counts only, no rows move."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations"))
               .select(F.lit(name).alias("check"), F.lit(table).alias("table"), "violations")
             for name, (table, df) in checks.items()]
    return reduce(DataFrame.unionByName, parts)
