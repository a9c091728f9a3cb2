"""Load history: audit rows of every run, kept as a table.

A run's rows are one folder a layer, named by run id and layer, written whole. So
runs of any number of sessions add up; a retry of a layer under the same run id
replaces what its first try wrote instead of adding to it; and a run that dies
leaves the layers it finished. ``read_history`` reads what is there, in any
session, without a catalog; ``register`` makes it a partitioned table for SQL.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("run_id", "layer")


def new_run_id() -> str:
    """A name for a run that sorts by the time it began: give your scheduler's id instead where retries should replace."""
    from datetime import datetime, timezone

    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/audit/load_history"


def write_layer(spark: SparkSession, root: str, run_id: str, layer: str, rows: list[tuple], schema: T.StructType) -> None:
    """Keep the rows of one layer of a run, in place of those an earlier try of it kept."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"run id {run_id!r} must be letters, digits, dots, dashes and underscores")
    kept = [f for f in schema.fields if f.name not in KEYS]
    at = [schema.fieldNames().index(f.name) for f in kept]
    df = spark.createDataFrame([tuple(r[i] for i in at) for r in rows], T.StructType(kept)).coalesce(1)
    df.write.mode("overwrite").parquet(f"{_folder(root)}/run_id={run_id}/layer={layer}")


def read_history(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows of all runs: run id first, then the columns of ``schema``."""
    full = T.StructType([*(f for f in schema.fields if f.name not in KEYS), *(T.StructField(k, T.StringType()) for k in KEYS)])
    return spark.read.schema(full).parquet(_folder(root)).select("run_id", *schema.fieldNames())


def last_runs(history: DataFrame) -> DataFrame:
    """The latest row of every layer and table, from whichever run it is."""
    newest = F.max_by(F.struct(*history.columns), F.struct("started", "run_id"))
    return history.groupBy("layer", "table_name").agg(newest.alias("r")).select("r.*")


def register(spark: SparkSession, root: str, table: str, schema: T.StructType) -> None:
    """Make the history a table of the catalog, with the partitions that are there now."""
    full = T.StructType([*(f for f in schema.fields if f.name not in KEYS), *(T.StructField(k, T.StringType()) for k in KEYS)])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(KEYS)}) LOCATION '{_folder(root)}'")
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")
