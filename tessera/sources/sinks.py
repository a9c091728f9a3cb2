"""Table sinks: full reload with a staged write, namespaces, audit stamp.

A plain overwrite deletes the old data before the new data exists; a
failure in between leaves an empty table. ``publish`` writes each load to a
fresh versioned directory and only then points the catalog table at it, so
readers see either the old or the new version, and a failed load raises
with the old version still in place. Tables that belong together are written
under one version name and swapped by ``move_pointers``, all of them or none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")


def create_namespaces(spark: SparkSession, names=LAYERS, prefix: str = "") -> None:
    for n in names:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {prefix}{n}")


def define_table(spark: SparkSession, table: str, schema, path: str, *, replace: bool = False,
                 fmt: str = "parquet") -> None:
    """Idempotent table definition with its declared schema (the DDL step).

    ``replace=True`` drops the definition first (the data directory of an
    external table is left alone); otherwise an existing table is kept.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source=fmt, schema=schema)


def stamp(df: DataFrame, col: str = "dwh_create_date") -> DataFrame:
    """Load-time audit column (one timestamp per query, as a default would give)."""
    return df.withColumn(col, F.current_timestamp())


def new_version() -> str:
    return f"v-{uuid.uuid4().hex[:12]}"


def version_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table.replace('.', '/')}/{version}"


def write_version(df: DataFrame, root: str, table: str, *, partition_by: list[str] | None = None,
                  fmt: str = "parquet", version: str | None = None) -> str:
    path = version_path(root, table, version or new_version())
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def point_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet",
                partitioned: bool = False) -> None:
    """Create ``table`` over ``path`` or move the existing table to it (metadata only).

    A partitioned table then has its partition list synced with the new
    directory (added and dropped), or readers would see the old partitions.
    """
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {table}")


def publish(spark: SparkSession, df: DataFrame, table: str, root: str, *,
            partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Full reload of ``table``: staged write, then a catalog pointer swap."""
    path = write_version(df, root, table, partition_by=partition_by, fmt=fmt)
    point_table(spark, table, path, fmt, partitioned=bool(partition_by))
    return path


def table_location(spark: SparkSession, table: str) -> str | None:
    """Folder the catalog table points at; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return row["data_type"]


def move_pointers(spark: SparkSession, paths: dict[str, str], *, fmt: str = "parquet", partitioned=()) -> None:
    """Point every table of ``paths`` at its new folder, or none of them: where a
    swap fails, the tables already moved go back (new ones leave the catalog)."""
    before = {t: table_location(spark, t) for t in paths}
    moved = []
    try:
        for table, path in paths.items():
            moved.append(table)
            point_table(spark, table, path, fmt, partitioned=table in partitioned)
    except Exception:
        for table in moved:
            if before[table] is None:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            else:
                point_table(spark, table, before[table], fmt, partitioned=table in partitioned)
        raise


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged version that no table was pointed at."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_old_versions(spark: SparkSession, root: str, table: str, keep: int) -> list[str]:
    """Delete the versions of ``table`` but the one the catalog points at and the
    ``keep - 1`` newest others; returns the names deleted. Not for use while another
    load of the same table is running: its staged version is one of the others."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    folder = spark._jvm.org.apache.hadoop.fs.Path(version_path(root, table, ""))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    location = table_location(spark, table)
    if location is None or not fs.exists(folder):
        return []
    current = location.rstrip("/").rsplit("/", 1)[-1]
    others = sorted(((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(folder)
                     if s.getPath().getName().startswith("v-") and s.getPath().getName() != current), reverse=True)
    old = [name for _, name in others[keep - 1:]]
    for name in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, name), True)
    return old
