"""Measured skew: heavy hitters of key columns, found while a table is written, used when it is joined.

``observed`` adds a heavy-hitter sketch of each key column to a write (Spark's
``approx_top_k``; a few kilobytes a task, merged by the driver, no pass of its
own). Every value that holds more than about one in ``FOUND`` rows is in it, with its
count. The counts are stored as table properties, beside the rows and NULLs, so
that later sessions know them, and summed when several tables are united.

A shuffled join then spreads exactly the values that need it: a value with more
rows than a ``SPREAD``-th of a reducer's share gets as many buckets as bring it down to
that, its rows take a bucket by their hash, and the few dimension rows of such
values are repeated for each bucket. NULL keys, which match nothing, are spread
alike and find no row. Values below stay as they are; nothing is dropped, and
results don't depend on the sketch, which may be old or wrong.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import exact

#: Values a sketch gives, and values it tracks; it finds all above one row in three quarters of these.
TOP, TRACKED = 128, 1024
FOUND = TRACKED * 3 // 4
#: Buckets of a hot value for each reducer's share of rows that it holds.
SPREAD = 4
PROPERTY = "tessera.hot."


@dataclass(frozen=True)
class HotKeys:
    """Rows of a table, those whose key is NULL, and rows of the values that hold most."""
    rows: int
    nulls: int = 0
    counts: dict = field(default_factory=dict)

    def buckets(self, partitions: int) -> dict:
        """Buckets of every value (and of None, the NULL keys) that holds more than a ``SPREAD``-th of a reducer's share."""
        share = max(self.rows / partitions / SPREAD, 1.0)
        held = {v: n for v, n in [*self.counts.items(), (None, self.nulls)] if n > share}
        return {v: min(-int(-n // share), SPREAD * partitions) for v, n in held.items()}

    def to_json(self) -> str:
        return json.dumps({"rows": self.rows, "nulls": self.nulls, "counts": sorted(self.counts.items(), key=lambda x: (-x[1], str(x[0])))})

    @staticmethod
    def from_json(text: str) -> "HotKeys":
        x = json.loads(text)
        return HotKeys(x["rows"], x["nulls"], {v: n for v, n in x["counts"]})


def united(parts: list[HotKeys | None]) -> HotKeys | None:
    """Heavy hitters of a union of tables; None unless all are known."""
    if not parts or any(p is None for p in parts):
        return None
    counts: Counter = Counter()
    for p in parts:
        counts.update(p.counts)
    return HotKeys(sum(p.rows for p in parts), sum(p.nulls for p in parts), dict(counts))


def sketch(df: DataFrame, columns) -> list[Column]:
    """Aggregates that measure key columns (numbers or text) in a pass over ``df``."""
    out = [F.count(F.lit(1)).alias("hot_rows")]
    for c in columns:
        key = f"collate(`{c}`, 'UTF8_BINARY')" if isinstance(df.schema[c].dataType, T.StringType) else f"`{c}`"
        out += [F.expr(f"approx_top_k({key}, {TOP}, {TRACKED})").alias(f"hot_top_{c}"), F.count_if(F.col(f"`{c}`").isNull()).alias(f"hot_nulls_{c}")]
    return out


def measured(metrics: dict, columns) -> dict[str, HotKeys]:
    """``HotKeys`` by column from the values of ``sketch``."""
    return {c: HotKeys(metrics["hot_rows"], metrics[f"hot_nulls_{c}"], {x["item"]: x["count"] for x in metrics[f"hot_top_{c}"] or [] if x["item"] is not None})
            for c in columns}


def observed(df: DataFrame, name: str, columns) -> tuple[DataFrame, Observation]:
    """``df`` that measures its key columns when it is written; ``measured(observation.get, columns)`` afterwards."""
    seen = Observation(name)
    return df.observe(seen, *sketch(df, columns)), seen


def store(spark: SparkSession, table: str, hot: dict[str, HotKeys]) -> None:
    """Keep the measures with the table (in place of those of an earlier load)."""
    if hot:
        pairs = ", ".join("'{}' = '{}'".format(PROPERTY + c, h.to_json().replace("\\", "\\\\").replace("'", "\\'")) for c, h in hot.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def stored(spark: SparkSession, table: str) -> dict[str, HotKeys]:
    """Measures kept with a table, by column; empty if there are none."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"].removeprefix(PROPERTY): HotKeys.from_json(r["value"]) for r in rows if r["key"].startswith(PROPERTY)}


def row_bucket(df: DataFrame, buckets) -> Column:
    """Bucket of a row from its stored values: a recomputed task puts it in the same one."""
    def value(f):
        c = F.col(f"`{f.name}`")
        return exact(c) if isinstance(f.dataType, T.StringType) else c

    values = [value(f) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.pmod(F.xxhash64(*values), buckets).cast("int")


def _buckets_of(key: Column, buckets: dict) -> Column | None:
    """The number of buckets of a key, 1 for values that have none of their own."""
    out = None
    for value, n in buckets.items():
        at = key.isNull() if value is None else key == F.lit(value)
        out = (F.when if out is None else out.when)(at, F.lit(n).cast("long"))
    return F.lit(1).cast("long") if out is None else out.otherwise(F.lit(1).cast("long"))


def salted(fact: DataFrame, side: DataFrame, key: str, buckets: dict, salt: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a column ``salt`` to join on beside ``key``: hot rows spread, their matches repeated."""
    fact = fact.withColumn(salt, row_bucket(fact, _buckets_of(F.col(key), buckets)))
    known = {v: n for v, n in buckets.items() if v is not None}
    copies = F.sequence(F.lit(0), (_buckets_of(F.col(key), known) - 1).cast("int"))
    return fact, side.withColumn(salt, F.explode(copies))
