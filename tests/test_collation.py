"""Text compares without regard to case and trailing blanks, from the clean layer to the facts."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import specs
from tessera.functions.text import collated, collation_key, distinct_collated, exact, group_collated
from tessera.operators import dims as D
from tessera.operators import quality as Q
from tessera.operators.star import DimLink, build_fact
from tessera.plans import gold
from tessera.plans.checks import quality_checks
from tessera.plans.pipeline import FactKeyError, Warehouse
from tests.test_pipeline import wide_line, write


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_groups_and_distinct_rows(spark):
    rows = [(1, "a"), (1, "A "), (1, "b"), (2, None), (2, None), (2, "É"), (2, "é")]
    df = spark.createDataFrame(rows, "i int, s string")
    for typed in (df, df.withColumn("s", collated("s"))):
        got = distinct_collated(typed)
        assert sorted(map(tuple, got.collect()), key=str) == [(1, "A "), (1, "b"), (2, "É"), (2, None)]
        assert got.schema["s"].dataType == typed.schema["s"].dataType
        sums = group_collated(typed, ["s"], F.sum("i").alias("n"), F.count(F.lit(1)).alias("rows"))
        assert sums.columns == ["s", "n", "rows"] and {r[0]: r[1:] for r in sums.collect()} == {"A ": (2, 2), "b": (1, 1), None: (4, 2), "É": (4, 2)}
        assert {tuple(r) for r in Q.duplicates(typed, ["i", "s"]).collect()} == {(1, "A ", 2), (2, "É", 2), (2, None, 2)}
        assert Q.duplicates(typed.limit(0), ["s"]).count() == 0
        # checks of blanks and characters see what the collation does not
        assert {r["s"] for r in Q.untrimmed_rows(typed, ["s"]).collect()} == {"A "}
        assert {r["s"] for r in Q.nonstandard_values(typed, "s").collect()} == {"É"}
    assert distinct_collated(df.select("i")).count() == 2


@pytest.mark.parametrize("budget", [None, 0])
def test_mixed_case_keys_give_one_member_and_lose_no_fact(spark, budget):
    frames = [spark.createDataFrame([("1.a", "guests", "TAG"), ("1.A", "GUESTS", "tag "), ("2.b ", "x", "Tag")], "Indicator_code string, Indicator string, Source_Table string")]
    dim = D.indicator_dim(frames, one_name=True)
    assert [tuple(r) for r in dim.df.orderBy("Indicator_key").collect()] == [(1, "1.A", "GUESTS", "TAG"), (2, "2.b ", "x", "Tag")]
    fact = spark.createDataFrame([("1.a", "tag", 1), ("1.A ", "TAG", 2), ("2.B", "tAg  ", 3), ("3", "tag", 4), (None, "tag", 5)], "code string, tag string, Value int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if budget == 0 else str(10 << 20))
    try:
        out = build_fact(fact, [DimLink(dim, {"Indicator_id": "code", "Source_Table": "tag"})], max_broadcast_bytes=budget)
        text = plan(out)
        assert ("SortMergeJoin" if budget == 0 else "BroadcastHashJoin") in text and "collationkey" in text and "NestedLoop" not in text
        assert {r["Value"]: r["Indicator_key"] for r in out.collect()} == {1: 1, 2: 1, 3: 2, 4: None, 5: None}
        literal = build_fact(fact, [DimLink(dim, {"Indicator_id": "code", "Source_Table": "tag"}, collated=())], max_broadcast_bytes=budget)
        assert {r["Value"]: r["Indicator_key"] for r in literal.collect()} == {1: None, 2: None, 3: None, 4: None, 5: None}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SPECS = tuple(specs.TABLES_BY_STEM[s] for s in ("domestic_trip", "inbound_accommodation"))


@pytest.fixture(scope="module")
def spelled(spark, tmp_path_factory):
    """Two extracts that spell codes, units and countries in several ways, and one country by two names."""
    root, inputs = str(tmp_path_factory.mktemp("spelled")), {}
    for spec in SPECS:
        lines = [wide_line(spec, "380", "2.a", "ITALY", ["Guests", "", "", ""], "units", {1995: "1", 1997: "2"}),
                 wide_line(spec, "380", "2.A", "Italy ", ["GUESTS", "", "", ""], "Units ", {1998: "3"}),
                 wide_line(spec, "380", "2.A", "ITALIA", ["guests staying", "", "", ""], "UNITS", {1999: "4"}),
                 wide_line(spec, "724", "2.b", "SPAIN", ["Nights", "", "", ""], "nights", {2000: "5"})]
        inputs[spec.stem] = os.path.join(root, spec.file_name)
        write(inputs[spec.stem], ";".join(spec.raw_schema().fieldNames()), lines)
    return root, inputs


def test_clean_tables_carry_the_collation(spark, spelled):
    root, inputs = spelled
    wh = Warehouse(spark, f"{root}/a", tables=SPECS, parallelism=2, prefix="coll_")
    wh.define(replace=True)
    kinds = {f.name: f.dataType for f in spark.table("coll_silver.domestic_trip").schema.fields}
    wh.run(inputs)
    assert {f.name: f.dataType for f in spark.table("coll_silver.domestic_trip").schema.fields} == kinds
    assert kinds["Country"] == kinds["Indicator_code"] == T.StringType(specs.COLLATION)
    ask = lambda q: [tuple(r) for r in spark.sql(q.format(t="coll_silver.domestic_trip")).collect()]
    assert ask("SELECT count(DISTINCT Indicator_code), count(DISTINCT Units) FROM {t}") == [(2, 2)]
    assert ask("SELECT count(*) FROM {t} WHERE Country = 'italy'") == [(2,)]
    assert sorted(ask("SELECT Units, count(*) FROM {t} GROUP BY Units"), key=lambda r: r[1])[1][1] == 3
    assert ask("SELECT count(*) FROM {t} WHERE startswith(Indicator_code, '2.A')") == [(3,)]
    # every filled cell finds its keys
    for fact in ("fact_domestic_tourism", "fact_inbound_tourism"):
        rows = spark.table(f"coll_gold.{fact}").collect()
        assert len(rows) == 5 and all(None not in tuple(r) for r in rows)
    assert spark.table("coll_gold.dim_indicator").count() == 4 and spark.table("coll_gold.dim_country").count() == 2


def test_aliases_are_kept_and_reported(spark, spelled):
    root, inputs = spelled
    wh = Warehouse(spark, f"{root}/b", tables=SPECS, prefix="alias_")
    wh.run(inputs)
    assert [tuple(r) for r in spark.table("alias_gold.dim_country_alias").collect()] == [(380, "ITALY", "ITALIA")]
    assert {(r["Indicator_id"], r["alias"], r["kept_name"]) for r in spark.table("alias_gold.dim_indicator_alias").collect()} == {("2.A", "GUESTS STAYING", "GUESTS")}
    checks = quality_checks(spark, SPECS, conflict_pair=("domestic_trip", "inbound_accommodation"), prefix="alias_")
    assert checks["id_conflict:dim_country_alias"][1].count() == 1 and checks["id_conflict:dim_indicator_alias"][1].count() == 2
    assert set(wh.read_star()) >= set(gold.ALIAS_TABLES)
    # the literal form has every name in the dimension, and no alias tables stay from the load before
    literal = Warehouse(spark, f"{root}/c", tables=SPECS, prefix="alias_", options=gold.GoldOptions(one_name=False))
    literal.run(inputs)
    assert not spark.catalog.tableExists("alias_gold.dim_country_alias") and spark.table("alias_gold.dim_country").count() == 3


def test_a_key_lost_by_the_join_fails_the_load(spark, spelled, monkeypatch):
    root, inputs = spelled
    real = DimLink.__init__
    monkeypatch.setattr(DimLink, "__init__", lambda self, *a, **k: real(self, *a, **(k | {"collated": ()})))
    wh = Warehouse(spark, f"{root}/d", tables=SPECS, prefix="lost_")
    with pytest.raises(FactKeyError, match="dim_indicator"):
        wh.run(inputs)
    assert not spark.catalog.tableExists("lost_gold.dim_country")


def test_one_scan_of_each_clean_table_finds_all_members(spark, spelled):
    root, inputs = spelled
    wh = Warehouse(spark, f"{root}/e", tables=SPECS, prefix="scan_")
    wh.run(inputs)
    silver = wh.silver()
    text = plan(gold.members_query(silver, SPECS))
    assert text.count("FileScan parquet") == len(SPECS) and text.count("Expand") == 1
    assert "year_1995" not in text                       # descriptors only
    members = gold.natural_members(silver, SPECS)
    assert {r["set"] for r in members.select("set").distinct().collect()} == {"member", "indicator", "unit", "year"}
    for dim in gold.build_dims(silver, tables=SPECS, members=members).values():
        assert "FileScan" not in plan(dim.df)
    assert wh.cells == {s.stem: 5 for s in SPECS}          # counted while the clean tables were written
    fresh = Warehouse(spark, f"{root}/e", tables=SPECS, prefix="scan_")      # another session: counted by a scan
    assert fresh.load_star().facts and fresh.cells == {}


def test_exact_and_key_forms(spark):
    df = spark.createDataFrame([("a ", "A")], "x string, y string")
    r = df.select(collated("x") == collated("y"), exact(collated("x")) == exact("y"), collation_key("x") == collation_key("y")).first()
    assert tuple(r) == (True, False, True)
