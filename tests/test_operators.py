"""Operators: unpivot, unions, dense keys, dimensions, star joins, quality checks."""

import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import specs
from tessera.operators import dims as D
from tessera.operators import quality as Q
from tessera.operators.keys import dense_key
from tessera.operators.reshape import union_tagged, unpivot_years, widen
from tessera.operators.star import DimLink, build_fact, star_join


def wide_row(spark, filled: dict):
    schema = specs.clean_wide_schema(False)
    vals = {f.name: None for f in schema.fields}
    vals.update({"Country_code": 4, "Indicator_code": "1.1", "Country": "ITALY", "Units": "Units"})
    vals.update({specs.year_col(y): Decimal(v) for y, v in filled.items()})
    return spark.createDataFrame([tuple(vals[f.name] for f in schema.fields)], schema)


def test_unpivot_two_filled_years(spark):
    df = wide_row(spark, {1995: "1.50", 2020: "3.00"})
    out = unpivot_years(df, ["Country_code", "Indicator_code"], drop_nulls=True).collect()
    assert sorted((r.Year, r.Value) for r in out) == [(1995, Decimal("1.50")), (2020, Decimal("3.00"))]
    assert unpivot_years(df, ["Country_code"]).count() == 28


def test_unpivot_round_trip(spark):
    df = wide_row(spark, {1995: "1.00", 1999: "2.00", 2022: "5.25"})
    years = [specs.year_col(y) for y in specs.CLEAN_YEARS]
    long = unpivot_years(df, ["Country_code"], years, drop_nulls=True)
    back = long.groupBy("Country_code").pivot("Year", list(specs.CLEAN_YEARS)).agg(F.first("Value"))
    row = back.collect()[0]
    assert row["1995"] == Decimal("1.00") and row["2022"] == Decimal("5.25") and row["1996"] is None


def test_widen_adds_typed_nulls(spark):
    raw = spark.createDataFrame([("1",)], "year_1995 string")
    out = widen(raw, T.StructType([T.StructField("year_1995", T.IntegerType()),
                                   T.StructField("year_1996", specs.VALUE_TYPE)]))
    assert out.schema["year_1996"].dataType == specs.VALUE_TYPE
    assert out.collect()[0].year_1995 == 1


def test_union_tagged(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2, "y", 9)], "id int, name string, extra int")
    out = union_tagged({"A": a, "B": b}, allow_missing=True).orderBy("id").collect()
    assert [(r.id, r.Source_Table, r.extra) for r in out] == [(1, "A", None), (2, "B", 9)]


def test_dense_key_matches_window(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 500), rnd.choice("abcde")) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k int, s string").distinct()
    got = dense_key(df, ["k", "s"], "key", partitions=7)
    want = df.withColumn("key", F.row_number().over(Window.orderBy("k", "s")).cast("long"))
    assert got.rows == df.count()
    assert sorted(got.df.collect()) == sorted(want.select("key", "k", "s").collect())
    keys = [r.key for r in got.df.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_dense_key_ties_split(spark):
    # one hot value holding most rows: identical rows still get 1..N
    rows = [(1, "HOT")] * 2000 + [(i, "x") for i in range(2, 300)]
    df = spark.createDataFrame(rows, "k int, s string")
    got = dense_key(df, ["k", "s"], "key", partitions=8, split_ties=True)
    keys = sorted(r.key for r in got.df.collect())
    assert keys == list(range(1, len(rows) + 1))
    hot = sorted(r.key for r in got.df.filter("s = 'HOT'").collect())
    assert hot == list(range(1, 2001))


def test_member_dim_dedupe_and_literal(spark):
    src = [spark.createDataFrame([(1, "ITALY"), (2, "SPAIN"), (None, "X"), (3, None)], "id int, name string")
           for _ in range(3)]
    d = D.member_dim(src)
    assert [(r.Country_key, r.Country_id) for r in d.df.orderBy("Country_key").collect()] == [(1, 1), (2, 2)]
    lit = D.member_dim(src, dedupe=False)
    assert lit.rows == 6
    assert Q.dim_key_unique(lit).count() == 2
    assert Q.dim_key_unique(d).count() == 0


def test_year_dim_reads_schema_years(spark):
    wide = wide_row(spark, {})
    sdg = spark.createDataFrame([(2023,), (2023,), (None,)], "Year int")
    d = D.year_dim([sdg], [wide])
    years = [r.Year for r in d.df.orderBy("Year_key").collect()]
    assert years == list(range(1995, 2023)) + [2023]


def test_star_join_unknown_member_and_collated_units(spark):
    c = D.member_dim([spark.createDataFrame([(1, "ITALY")], "id int, name string")])
    u = D.unit_dim([spark.createDataFrame([("Units",), ("Thousands",)], "Units string")])
    fact = spark.createDataFrame([(1, "thousands ", Decimal("1.00")), (9, "NUMBER", Decimal("2.00")),
                                  (1, "x", None)], "cc int, u string, Value decimal(18,2)")
    links = [DimLink(c, {"Country_id": "cc"}), DimLink(u, {"Measure_Units": "u"}, collated=("Measure_Units",))]
    out = build_fact(fact, links).orderBy("Value").collect()
    assert [(r.Country_key, r.Units_key, r.Value) for r in out] == \
        [(1, 2, Decimal("1.00")), (None, 1, Decimal("2.00"))]
    # same rows when the dimensions are not broadcast
    out2 = star_join(fact.filter("Value is not null"), links, ["Value"], max_broadcast_bytes=0)
    assert sorted(map(tuple, out2.collect()), key=str) == sorted(map(tuple, out), key=str)


def test_quality_checks(spark):
    df = spark.createDataFrame([("ITALY ", "a"), ("ÉIRE", "b"), ("SPAIN", "c"), ("SPAIN", "d")],
                               "Country string, Units string")
    assert [r.Country for r in Q.duplicates(df, ["Country"]).collect()] == ["SPAIN"]
    bad = Q.untrimmed_rows(df).collect()
    assert [(r.Country, r.untrimmed_columns) for r in bad] == [("ITALY ", "Country")]
    assert [r.Country for r in Q.nonstandard_values(df, "Country").collect()] == ["ÉIRE"]
    assert Q.distinct_values(df, "Country").count() == 3
    left = spark.createDataFrame([(1, "ITALY"), (2, "SPAIN"), (3, "CHAD")], "id int, name string")
    right = spark.createDataFrame([(1, "italy "), (2, "ESPANA"), (4, "PERU")], "id int, name string")
    full = {r.ID: r.Status for r in Q.id_conflicts(left, right, "id", "name", only_conflicts=False).collect()}
    assert full == {1: "OK", 2: "Country_Conflict", 3: "Missing_in_SDG", 4: "Missing_in_Accommodation"}
    only = Q.id_conflicts(left, right, "id", "name").collect()
    assert [(r.ID, r.Status) for r in only] == [(2, "Country_Conflict")]
    summary = {r.check: r.violations for r in Q.summarize({
        "duplicates": ("t", Q.duplicates(df, ["Country"])),
        "blanks": ("t", Q.untrimmed_rows(df))}).collect()}
    assert summary == {"duplicates": 1, "blanks": 1}


def test_fk_violations(spark):
    c = D.member_dim([spark.createDataFrame([(1, "ITALY"), (2, "SPAIN")], "id int, name string")])
    y = D.year_dim([spark.createDataFrame([(2000,)], "Year int")])
    fact = spark.createDataFrame([(1, 1, 1.0), (None, 1, 2.0), (2, 5, 3.0), (None, None, 4.0)],
                                 "Country_key long, Year_key long, Value double")
    out = {r.Value: r.failed_keys for r in Q.fk_violations(fact, [c, y]).collect()}
    assert out == {2.0: "Country_key", 3.0: "Year_key", 4.0: "Country_key,Year_key"}


def test_fk_violations_with_dimension_columns(spark):
    c = D.member_dim([spark.createDataFrame([(1, "ITALY")], "id int, name string")])
    fact = spark.createDataFrame([(1, 1.0), (7, 2.0)], "Country_key long, Value double")
    out = Q.fk_violations(fact, [c], with_dimensions=True)
    assert out.columns == ["Country_key", "Value", "dim_country__Country_key", "dim_country__Country_id",
                           "dim_country__Country_name", "failed_keys"]
    assert [(r.Value, r.dim_country__Country_id, r.failed_keys) for r in out.collect()] == \
        [(2.0, None, "Country_key")]


def test_fk_violations_spread_null_keys_in_shuffled_joins(spark):
    c = D.member_dim([spark.createDataFrame([(1, "ITALY"), (2, "SPAIN")], "id int, name string")])
    rows = [(None if i % 3 else 1 + i % 4, float(i)) for i in range(90)]
    fact = spark.createDataFrame(rows, "Country_key long, Value double")
    want = sorted(v for k, v in rows if k not in (1, 2))
    spark.conf.set("tessera.broadcast.maxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.fk_violations(fact, [c])
        plan = out._jdf.queryExecution().toString()
        got = out.collect()
    finally:
        spark.conf.unset("tessera.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "hashpartitioning(coalesce(" in plan
    assert sorted(r.Value for r in got) == want
    assert {r.Country_key for r in got} == {None, 3, 4}


def test_salted_join_matches_plain_join_under_skew(spark):
    from tessera.operators.star import find_hot_keys
    # one member holds a third of the rows, another sixth have no key at all
    rows = [(1, float(i)) for i in range(600)] + [(None, float(i)) for i in range(300)] + \
           [(k % 50 + 2, float(k)) for k in range(900)]
    fact = spark.createDataFrame(rows, "cc int, Value double")
    c = D.member_dim([spark.createDataFrame([(k, f"M{k}") for k in range(1, 60)], "id int, name string")])
    assert 1 in find_hot_keys(fact, "cc", 0.2)
    plain = star_join(fact, [DimLink(c, {"Country_id": "cc"})], ["Value"], max_broadcast_bytes=0)
    salted = star_join(fact, [DimLink(c, {"Country_id": "cc"}, salt_buckets=8, hot_support=0.2)],
                       ["Value"], max_broadcast_bytes=0)
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        salted.explain()
    assert "SortMergeJoin" in buf.getvalue() and "_salt0" in buf.getvalue()
