"""Heavy hitters measured by a write spread a join; bitmaps find the same missing keys without moving a fact."""

import contextlib
import io
import os
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from tessera import specs
from tessera.operators import dims as D
from tessera.operators import quality as Q
from tessera.operators import skew
from tessera.operators.bitmap import BUCKET, key_bitmap, with_membership
from tessera.operators.star import DimLink, build_fact
from tessera.plans.pipeline import Warehouse
from tests.test_pipeline import build_inputs


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def shuffled(spark):
    """Sixteen reducers that nothing evens out afterwards, and no broadcasts."""
    own = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "tessera.broadcast.maxBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_of_tasks(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def a_third(spark, n=48_000):
    """A third of the rows with one key, a sixth without a key."""
    i = F.col("id")
    return spark.range(n).select(F.when(i % 3 == 0, 7).when(i % 6 == 1, F.lit(None)).otherwise(i % 900 + 10).cast("int").alias("k"), i.alias("Value"))


def test_measures_are_kept_and_added(spark, tmp_path):
    df = a_third(spark).withColumn("s", F.when(F.col("Value") % 4 == 0, "it's \\ \"x\"").otherwise(F.col("Value").cast("string")))
    measuring, seen = skew.observed(df, "m", ["k", "s"])
    measuring.write.parquet(str(tmp_path / "t"))
    hot = skew.measured(seen.get, ["k", "s"])
    assert (hot["k"].rows, hot["k"].nulls, hot["s"].nulls) == (48_000, 8_000, 0)
    assert abs(hot["k"].counts[7] - 16_000) <= 48_000 / skew.FOUND and abs(hot["s"].counts["it's \\ \"x\""] - 12_000) <= 48_000 / skew.FOUND
    spark.sql("CREATE NAMESPACE IF NOT EXISTS measured")
    spark.sql(f"CREATE TABLE measured.t USING parquet LOCATION '{tmp_path}/t'")
    skew.store(spark, "measured.t", hot)
    assert skew.stored(spark, "measured.t") == hot
    both = skew.united([hot["k"], hot["k"]])
    assert both.rows == 96_000 and both.counts[7] == 2 * hot["k"].counts[7]
    assert skew.united([hot["k"], None]) is None and skew.united([]) is None
    assert skew.HotKeys(0).buckets(16) == {}
    spread = hot["k"].buckets(16)
    assert set(spread) == {7, None} and spread[7] == -(-hot["k"].counts[7] // 750) and max(spread.values()) <= 16 * skew.SPREAD


def test_every_heavy_value_is_found(spark):
    rnd = random.Random(3)
    n = 60_000
    keys = [rnd.randint(1000, 60_000) for _ in range(n)]
    for v in range(40):
        for j in range(n // 200):
            keys[(v * (n // 200) + j)] = v
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(8)
    hot = skew.measured(df.agg(*skew.sketch(df, ["k"])).first().asDict(), ["k"])["k"]
    assert set(range(40)) <= set(hot.counts)


def test_a_third_in_one_key_leaves_no_long_task(spark, shuffled):
    lines = a_third(spark)
    dim = D.member_dim([spark.range(910).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), "id").alias("name"))])
    hot = skew.measured(lines.agg(*skew.sketch(lines, ["k"])).first().asDict(), ["k"])
    plain = build_fact(lines, [DimLink(dim, {"Country_id": "k"})])
    spread = build_fact(lines, [DimLink(dim, {"Country_id": "k"}, hot=hot)])
    assert "SortMergeJoin" in plan(spread) and "Broadcast" not in plan(spread)
    before, after = rows_of_tasks(plain), rows_of_tasks(spread)
    assert max(before) > 6 * median(before)
    assert max(after) <= 3 * median(after) and sum(after) == sum(before) == 48_000
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    # old or wrong measures cost time, not rows
    wrong = {"k": skew.HotKeys(100, 50, {7: 1, 11: 100, 5000: 70})}
    assert build_fact(lines, [DimLink(dim, {"Country_id": "k"}, hot=wrong)]).exceptAll(plain).count() == 0


def test_text_keys_in_any_spelling(spark, shuffled):
    lines = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "Aa").when(F.col("id") % 3 == 1, "aA ").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("u"),
                                     F.col("id").alias("Value"))
    dim = D.unit_dim([lines.select(F.col("u").alias("Units"))])
    hot = skew.measured(lines.agg(*skew.sketch(lines, ["u"])).first().asDict(), ["u"])
    out = build_fact(lines, [DimLink(dim, {"Measure_Units": "u"}, hot=hot)])
    assert out.where("Units_key IS NULL").count() == 0 and out.count() == 6000
    assert max(rows_of_tasks(out)) <= 3 * median(rows_of_tasks(out))


def test_foreign_keys_spread_alike(spark, shuffled):
    fact = a_third(spark).withColumnRenamed("k", "Country_key")
    keys = spark.range(1, 400).select(F.col("id").alias("Country_key"), F.concat(F.lit("n"), "id").alias("Country_name"))
    dim = D.Dimension("dim_country", keys, "Country_key", ["Country_name"], 399, {"Country_name": 2000})
    hot = skew.measured(fact.agg(*skew.sketch(fact, ["Country_key"])).first().asDict(), ["Country_key"])
    plain = Q.fk_violations(fact, [dim], method="join")
    spread = Q.fk_violations(fact, [dim], method="join", hot=hot)
    carried = Q.fk_violations(fact, [dim], hot=hot, with_dimensions=True)
    want = {v: k for k, v in fact.where("Country_key IS NULL OR Country_key > 399").collect()}
    for out in (plain, spread, carried, Q.fk_violations(fact, [dim], method="bitmap"), Q.fk_violations(fact, [dim])):
        assert {r["Value"]: r["Country_key"] for r in out.collect()} == want
    # all rows of the join, not only the violations
    joined = Q.fk_violations(fact, [D.Dimension("d", keys.limit(0), "Country_key", ["Country_name"], 399, {"Country_name": 2000})], method="join", hot=hot)
    assert joined.count() == 48_000 and max(rows_of_tasks(joined)) <= 3 * median(rows_of_tasks(joined))


def test_bitmap_index(spark):
    keys = spark.range(1, 3 * BUCKET).where(f"id <= {BUCKET} OR id % 3 = 0").selectExpr("id AS k", "'wide' AS more")
    odd = spark.createDataFrame([(None, "x"), (0, "x"), (-4, "x"), (1, "again"), (10 ** 12, "far")], "k long, more string")
    index = key_bitmap(keys.unionByName(odd), "k")
    assert (index.buckets, index.with_words) == (5, 4) and index.bytes < 40_000
    asked = spark.range(-5, 3 * BUCKET + 9).selectExpr("CASE WHEN id % 1000 = 7 THEN NULL ELSE id END AS k").union(odd.select("k"))
    known = {r["k"] for r in keys.collect()} | {10 ** 12}
    out = with_membership(asked, "k", index, "hit")
    known |= {0, -4}
    assert all(r["hit"] == (r["k"] in known) for r in out.collect()) and out.count() == asked.count()
    assert "Exchange hashpartitioning" not in plan(out) and "BroadcastHashJoin" in plan(out)
    assert not with_membership(asked, "k", key_bitmap(keys.limit(0), "k"), "hit").where("hit").count()


def test_large_dimensions_are_indexed_by_default(spark):
    """Above the broadcast budget the keys' bitmap is still tiny, and the fact isn't shuffled."""
    n = 200_000
    dim = D.Dimension("d", spark.range(1, n + 1).select(F.col("id").alias("Country_key"), F.lit("name").alias("Country_name")), "Country_key", ["Country_name"], n, {"Country_name": 4 * n})
    fact = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") * 333).alias("Country_key"))
    spark.conf.set("tessera.broadcast.maxBytes", str(64 * 1024))
    try:
        out = Q.fk_violations(fact, [dim])
        assert "Exchange hashpartitioning" not in plan(out)
        assert out.count() == fact.where(f"Country_key IS NULL OR Country_key > {n}").count() > 300
    finally:
        spark.conf.unset("tessera.broadcast.maxBytes")
    with pytest.raises(ValueError):
        Q.fk_violations(fact, [dim], method="bitmap", with_dimensions=True)


def test_a_load_measures_its_tables(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "t"), max_reject_fraction=0.5, parallelism=3, prefix="skew_",
                   tables=tuple(specs.TABLES_BY_STEM[s] for s in ("domestic_trip", "sdg_891")))
    inputs = build_inputs(str(tmp_path / "in"))
    wh.run({t.stem: inputs[t.stem] for t in wh.tables})
    clean = skew.stored(spark, "skew_silver.domestic_trip")
    assert set(clean) == {"Country_code", "Indicator_code"} and clean["Country_code"].counts == {380: 1, 724: 1} and clean["Country_code"].nulls == 1
    facts = skew.stored(spark, "skew_gold.fact_domestic_tourism")
    assert set(facts) == {"Country_key", "Indicator_key", "Year_key", "Units_key"}
    assert facts["Country_key"].rows == spark.table("skew_gold.fact_domestic_tourism").count()
    assert os.path.isdir(tmp_path / "t")
