"""Profiles merged from states equal those of all rows; key figures over years with gaps."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera import specs
from tessera.operators import profile as P
from tessera.operators.marts import kpis, rolled_up
from tessera.plans.pipeline import Warehouse
from tests.test_pipeline import build_inputs


def test_merged_profiles_equal_one_of_all_rows(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["Aa", "aA ", "b", "C", None]), rnd.randint(0, 3000) if rnd.random() < 0.6 else 7, float(i % 9), None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, s string, k int, x double, nothing string").repartition(3)
    for part in range(4):
        P.keep_profile(P.profile(df.where(F.col("id") % 4 == part)), str(tmp_path), "t", f"load-{part}")
    P.keep_profile(P.profile(df.where("id % 4 = 2")), str(tmp_path), "t", "load-2")              # again: replaced
    P.keep_profile(P.profile(df.limit(0), ["id"]), str(tmp_path), "empty", "load-0")
    got = {(r["table_name"], r["column_name"]): r for r in P.merged(P.kept_profiles(spark, str(tmp_path))).collect()}
    assert set(got) == {("t", c) for c in df.columns} | {("empty", "id")}
    for c in df.columns:
        values = [r[df.columns.index(c)] for r in rows]
        keys = [v.rstrip(" ").upper() if isinstance(v, str) else str(v) for v in values if v is not None]
        r, counts = got["t", c], Counter(keys)
        assert (r["rows"], r["nulls"]) == (len(rows), values.count(None))
        assert abs(r["distinct"] - len(counts)) <= max(1, P.ERROR * len(counts))
        if counts and len(counts) < P.FOUND:
            assert {x["value"]: x["rows"] for x in r["top"]} == dict(counts)
        elif c == "k":
            assert r["top"][0]["value"] == "7" and abs(r["top"][0]["rows"] - counts["7"]) <= len(rows) / P.FOUND
    assert (got["empty", "id"]["rows"], got["empty", "id"]["distinct"]) == (0, 0)
    with pytest.raises(ValueError):
        P.keep_profile(P.profile(df, ["id"]), str(tmp_path), "t", "a/b")


def test_profiles_of_a_warehouse_grow_with_its_runs(spark, tmp_path):
    inputs = build_inputs(str(tmp_path / "in"))
    chosen = tuple(specs.TABLES_BY_STEM[s] for s in ("domestic_trip", "sdg_891"))
    for run in ("a", "b", "b"):
        wh = Warehouse(spark, str(tmp_path / "t"), tables=chosen, prefix="prof_", max_reject_fraction=0.5, run_id=run)
        wh.load_raw({t.stem: inputs[t.stem] for t in chosen})
        wh.load_clean()
        got = {(r["table_name"], r["column_name"]): r for r in wh.profile().collect()}
    r = got["domestic_trip", "Country"]
    assert (r["rows"], r["nulls"], r["distinct"]) == (6, 2, 2) and {x["value"]: x["rows"] for x in r["top"]} == {"ITALY": 2, "SPAIN": 2}
    assert got["sdg_891", "Value"]["nulls"] == 4


def test_key_figures_over_years_with_gaps(spark):
    rows = [("it", "a", 2000, 10), ("it", "a", 2001, 20), ("it", "a", 2005, 50), ("it", "a", 2006, 60), ("es", "a", 2001, 40), ("es", "b", 2006, 7), ("es", "b", 2001, 0)]
    totals = spark.createDataFrame([(*r, 1) for r in rows], "c string, i string, Year int, total int, n long").withColumn("total", F.col("total").cast("decimal(38,2)"))
    rolled = rolled_up(totals, ["c", "i"])
    assert Counter(r["level"] for r in rolled.collect()) == {"c+i": 7, "c": 6, "i": 6, "all": 4}
    got = {(r["level"], r["c"], r["i"], r["Year"]): r for r in kpis(rolled, ["c", "i"], base_year=2001).collect()}
    assert len(got) == 23
    r = got["c+i", "it", "a", 2005]                   # 2003 and 2004 are missing: the mean doesn't reach back to 2001
    assert (r["moving_mean"], float(r["to_date"]), r["base_index"], r["share"]) == (50.0, 80.0, 250.0, 1.0)
    assert got["c+i", "it", "a", 2006]["moving_mean"] == 55.0 and got["c+i", "it", "a", 2001]["moving_mean"] == 15.0
    assert got["c+i", "es", "b", 2006]["base_index"] is None and got["c", "es", None, 2006]["base_index"] == 100 * 7 / 40
    assert got["c", "it", None, 2001]["share"] == 20 / 60 and got["all", None, None, 2006]["share"] == 1.0
    assert got["all", None, None, 2001]["base_index"] == 100.0 and float(got["all", None, None, 2006]["to_date"]) == sum(r[3] for r in rows)
    zero = spark.createDataFrame([("it", "a", 2000, 0, 1)], "c string, i string, Year int, total int, n long")
    assert {r["share"] for r in kpis(rolled_up(zero, ["c", "i"]), ["c", "i"], 2000).collect()} == {None}
    assert kpis(rolled_up(totals.limit(0), ["c", "i"]), ["c", "i"], 2000).count() == 0
