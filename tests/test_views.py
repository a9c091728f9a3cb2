"""The star as views: rows of the loaded tables, keys that stay."""

import os
from collections import Counter

import pytest

from tessera import specs
from tessera.plans.pipeline import Warehouse
from tessera.plans.views import MAPS, create_views, refresh_keys
from tests.test_pipeline import build_inputs, wide_line, write


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("views"))
    wh = Warehouse(spark, f"{root}/t", max_reject_fraction=0.5, parallelism=4, prefix="view_")
    wh.run(build_inputs(f"{root}/in"))
    return wh, create_views(wh)


def test_views_equal_the_loaded_tables(spark, loaded):
    wh, names = loaded
    assert len(names) == 9
    for name in names:
        table = spark.table(f"view_gold.{name.split('.')[1]}")
        assert spark.table(name).columns == table.columns and rows(spark.table(name)) == rows(table), name
    assert {t.tableType for t in spark.catalog.listTables("view_star")} == {"VIEW"}


def test_keys_stay_and_new_ones_follow(spark, loaded, tmp_path):
    wh, _ = loaded
    before = {m: {tuple(r) for r in spark.table(f"view_gold.{m}").collect()} for m in MAPS}
    facts = rows(spark.table("view_star.fact_outbound_tourism"))
    assert refresh_keys(wh) == dict.fromkeys(MAPS, 0)
    spec = specs.TABLES_BY_STEM["domestic_trip"]
    lines = [wide_line(spec, "4", "1.9", "AFGHANISTAN", ["New", "", "", ""], "beds", {1995: "5"}),           # sorts before all others
             wide_line(spec, "724", "2.19", "spain ", ["nights spent", "", "", ""], "NIGHTS", {2022: "9"})]
    path = str(tmp_path / "more.csv")
    write(path, ";".join(spec.raw_schema().fieldNames()), lines)
    again = Warehouse(spark, wh.root, prefix="view_")
    again.load_raw({spec.stem: path})
    again.load_clean()
    # the views see the clean tables at once; the key map doesn't know the new member yet
    seen = {(r["Country_key"], float(r["Value"])) for r in spark.table("view_star.fact_domestic_tourism").collect()}
    spain = dict((r[1], r[0]) for r in before["key_country"])[724]
    assert (None, 5.0) in seen and (spain, 9.0) in seen
    again.loaded = None                                  # keys come from all clean tables
    assert refresh_keys(again) == {"key_country": 1, "key_indicator": 1, "key_year": 0, "key_unit": 1}
    for m in MAPS:
        now = {tuple(r) for r in spark.table(f"view_gold.{m}").collect()}
        assert before[m] <= now and {r[0] for r in now} == set(range(1, len(now) + 1))
    assert rows(spark.table("view_star.fact_outbound_tourism")) == facts
    assert ("AFGHANISTAN", max(r[0] for r in before["key_country"]) + 1) in {(r["Country_name"], r["Country_key"]) for r in spark.table("view_star.dim_country").collect()}
    assert os.path.isdir(wh.root)


def test_columns_of_the_catalog(spark, loaded):
    from tessera.operators.dims import year_dim
    from tessera.sources.catalog import catalog_columns, publish_catalog

    wh, _ = loaded
    found = catalog_columns(spark, ["view_silver", "view_star"])
    for table in ("view_silver.inbound_arrivals", "view_star.fact_sdg"):
        namespace, name = table.split(".")
        got = [(r["column_name"], r["data_type"], r["position"]) for r in found.where(f"namespace = '{namespace}' AND table_name = '{name}'").orderBy("position").collect()]
        assert got == [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(spark.table(table).schema.fields, 1)]
    publish_catalog(spark, ["view_silver"], "view_gold.catalog_columns", wh.root)
    years = spark.sql("SELECT DISTINCT CAST(right(column_name, 4) AS INT) AS Year FROM view_gold.catalog_columns WHERE column_name LIKE 'year\\_%'")
    sdg = [spark.table(f"view_silver.{s}").selectExpr("year(Time_Period) AS Year") for s in ("sdg_891", "sdg_892", "sdg_12b1")]
    assert rows(year_dim([years, *sdg]).df) == rows(spark.table("view_gold.dim_year"))
    assert catalog_columns(spark, []).count() == 0
