"""Columns of the catalog's tables as a relation that SQL can ask.

Spark has no ``sys.columns``; ``catalog_columns`` puts the schemas of the tables of
some namespaces into rows, a row a column: a few kilobytes of metadata, read from
the catalog and not from any data. ``publish_catalog`` keeps them as a table, so
queries that take years, names or types from column metadata are plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.sinks import publish

SCHEMA = "namespace string, table_name string, column_name string, data_type string, position int, nullable boolean"


def catalog_columns(spark: SparkSession, namespaces: list[str]) -> DataFrame:
    """``namespace, table_name, column_name, data_type, position`` (from 1) and ``nullable`` of every column of every table and view."""
    rows = []
    for namespace in namespaces:
        for t in spark.catalog.listTables(namespace):
            if not t.isTemporary:
                for i, f in enumerate(spark.table(f"{namespace}.{t.name}").schema.fields, 1):
                    rows.append((namespace, t.name, f.name, f.dataType.simpleString(), i, f.nullable))
    return spark.createDataFrame(rows, SCHEMA)


def publish_catalog(spark: SparkSession, namespaces: list[str], table: str, root: str) -> DataFrame:
    """Keep ``catalog_columns`` as a table (replaced as a whole) and read it."""
    publish(spark, catalog_columns(spark, namespaces), table, root)
    return spark.table(table)
