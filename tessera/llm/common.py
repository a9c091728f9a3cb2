"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, scratch_path

#: ASCII white space; everything else belongs to a word.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package's modules to the executors (once an application), whose
    workers import the operators' task code from them."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-code-"), "tessera-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session: size it to the input as for any Spark job."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation) and gives the
    planner the real size of the table, so that Spark broadcasts it only if it
    is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` (a written table) with ``values`` (a row a key at most) that no hot key slows.

    Keys that hold more than a 4th of a shuffle partition's share of the rows
    number fewer than four times the partitions, so their values are broadcast
    with that bound; rows of these keys and of a null key stay where they are,
    the others meet their values by shuffle.
    """
    spark = rows.sparkSession
    least = max(1, rows.count() // (4 * partitions(spark)))
    known = rows.where(F.col(key).isNotNull())
    hot = materialise(known.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least).select(key), "hot-keys")
    own = hot.join(values.join(F.broadcast(hot), key, "left_semi"), key, "left").withColumn("_hot", F.lit(True))
    order = [*rows.columns, *(c for c in values.columns if c != key)]
    here = rows.join(F.broadcast(own), key, "left").where(F.col("_hot") | F.col(key).isNull())
    there = known.join(F.broadcast(hot), key, "left_anti").join(values, key, "left")
    return here.select(*order).union(there.select(*order))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node with an edge: columns ``node, label``.

    Alternating large-star / small-star over an edge table: every round is two
    aggregations and two joins on Spark (``min`` is combined before the
    shuffle, so a hub is no hot task), the edges are rewritten to point at
    smaller nodes and written to the shared folder. Ends when the edge set is
    a set of stars. Null ends and loops are ignored.
    """
    def oriented(df):
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    cur = materialise(oriented(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "cc-edges")
    before = None
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour of u (and u itself) hangs below the least of its ring
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        cur = oriented(large)
        # small star: the smaller neighbours of u, and u, hang below the least of them
        least = cur.groupBy("u").agg(F.min("v").alias("m"))
        small = (cur.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        cur = materialise(oriented(small), "cc-edges")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("connected components did not settle")
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
