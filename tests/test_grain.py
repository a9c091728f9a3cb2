"""One key per natural key, calendar years, and no lost rows."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import dims as D
from tessera.operators.marts import year_over_year
from tessera.specs import raw_slot


def test_least_name_and_aliases(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (1, "a"), (None, "x"), (3, None)], "Country_id int, Country_name string")
    src = df.select(F.col("Country_id").alias("id"), F.col("Country_name").alias("name"))
    rows = D.member_dim([src], one_name=True).df.orderBy("Country_key").collect()
    assert [tuple(r) for r in rows] == [(1, 1, "a"), (2, 2, "c")] or [(r["Country_id"], r["Country_name"]) for r in rows] == [(1, "a"), (2, "c")]
    assert [tuple(r) for r in D.aliases(df, ["Country_id"], "Country_name").collect()] == [(1, "b", "a")]
    assert D.member_dim([src]).rows == 3        # the literal form keeps a row per name


def test_year_over_year_needs_the_year_before(spark):
    df = spark.createDataFrame([("s", 2000, 5), ("s", 2003, 9), ("s", 2004, 10)], "s string, Year int, total int")
    got = {r["Year"]: r["change"] for r in year_over_year(df, ["s"]).collect()}
    assert got == {2000: None, 2003: None, 2004: 1}


def test_every_year_has_a_slot_or_the_job_fails(spark):
    df = spark.createDataFrame([(1995,), (1996,), (2021,)], "y int")
    assert [r[0] for r in df.select(raw_slot(F.col("y"))).collect()] == [1995, 1997, 2022]
    with pytest.raises(Exception, match="no raw year column for 1994"):
        spark.createDataFrame([(1994,)], "y int").select(raw_slot(F.col("y"))).collect()


def test_one_name_whatever_the_spelling(spark):
    from tessera.operators import quality as Q
    src = spark.createDataFrame([(1, "France"), (1, "FRANCE"), (1, "france "), (2, "Chad"), (2, "TCHAD")], "id int, name string")
    rows = D.member_dim([src]).df.orderBy("Country_key").collect()
    assert [(r["Country_key"], r["Country_id"], r["Country_name"]) for r in rows] == \
        [(1, 1, "FRANCE"), (2, 2, "Chad"), (3, 2, "TCHAD")]
    assert [tuple(r) for r in Q.duplicates(src, ["name"]).collect()] == [("FRANCE", 3)]
    assert [tuple(r) for r in Q.duplicates(src, ["id", "name"]).collect()] == [(1, "FRANCE", 3)]
    assert sorted(r[0] for r in Q.distinct_values(src, "name").collect()) == ["Chad", "FRANCE", "TCHAD"]
    empty = src.where("id > 9")
    assert Q.duplicates(empty, ["name"]).count() == D.member_dim([empty]).rows == 0


def test_unique_check_reports_conflicting_names(spark):
    from tessera.operators import quality as Q
    src = spark.createDataFrame([(1, "France"), (1, "Gaul"), (2, "Chad")], "id int, name string")
    assert [tuple(r) for r in Q.dim_key_unique(D.member_dim([src])).collect()] == [(1, 2)]
    assert Q.dim_key_unique(D.member_dim([src], one_name=True)).count() == 0


def test_id_conflicts_pair_each_name_once(spark):
    from tessera.operators import quality as Q
    left = spark.createDataFrame([(1, "Italy"), (1, "ITALY "), (2, "Spain")], "id int, name string")
    right = spark.createDataFrame([(1, "italy"), (2, "Espana"), (2, "ESPANA")], "id int, name string")
    rows = Q.id_conflicts(left, right, "id", "name", only_conflicts=False).collect()
    assert sorted((r.ID, r.Status) for r in rows) == [(1, "OK"), (2, "Country_Conflict")]
