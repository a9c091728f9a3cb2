"""What keeps the load's time in step with its input: compiled methods, keys by rank, text formatted once."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import parse_numeric_text
from tessera.operators import dims as D
from tessera.operators.bitmap import key_ranks
from tessera.operators.star import DimLink, build_fact
from tessera.plans.derive import lineitem_cube
from tessera.plans.gold import unresolved_keys
from tessera.plans.pipeline import Warehouse
from tessera.plans.silver import clean_table
from tessera.session import METHOD_BYTES
from tessera.specs import TABLES
from tests.test_plans import plan, tree_ops


@pytest.fixture
def small_budget(spark):
    spark.conf.set("tessera.broadcast.maxBytes", "20000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("tessera.broadcast.maxBytes")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_loads_run_in_methods_that_are_compiled(spark, tmp_dir):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    Warehouse(spark, tmp_dir, prefix="methods_")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_members_too_many_to_broadcast_move_no_fact(spark, small_budget):
    ids = [*range(-130, 3000, 2), 10 ** 9, 2 ** 31 - 1, -2 ** 31]
    dim = D.member_dim([spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string")], one_name=True)
    fact = spark.createDataFrame([(i, 1.0) for i in [*range(-200, 3100), *ids, None, 5]], "k int, Value double")
    out = build_fact(fact, [DimLink(dim, {"Country_id": "k"})], keep_extra=["k"])
    ops = tree_ops(plan(out))
    assert "SortMergeJoin" not in ops and "BroadcastHashJoin" in ops
    want = {i: n for n, i in enumerate(sorted(ids), 1)}
    rows = out.collect()
    assert len(rows) == 3300 + len(ids) + 2 and all(r["Country_key"] == want.get(r["k"]) for r in rows)


def test_keys_that_no_rank_gives_are_joined(spark, small_budget):
    pairs = spark.range(2000).select((F.lit(2000) - F.col("id")).alias("key"), F.col("id").cast("int").alias("k"))
    assert key_ranks(pairs, "k", "key", 10 ** 6) is None                                       # falling
    assert key_ranks(pairs.select("k", (F.col("k") + 1).alias("key")).unionByName(pairs.select(F.lit(7).alias("k"), F.lit(3000).alias("key"))), "k", "key", 10 ** 6) is None
    assert key_ranks(pairs.select((F.col("k") * 64).alias("k"), "key"), "k", "key", 20000) is None      # a word each: too large
    dim = D.Dimension("d", pairs, "key", ["k"], 2000)
    out = build_fact(spark.createDataFrame([(5, 1.0), (None, 2.0), (9999, 3.0)], "k int, Value double"), [DimLink(dim, {"k": "k"})])
    assert {tuple(r) for r in out.collect()} == {(1995, 1.0), (None, 2.0), (None, 3.0)}


def test_lost_and_repeated_keys_are_still_found(spark):
    members = spark.createDataFrame([("member", 1, "A"), ("member", 2, "B"), ("member", 2, "b"), ("member", None, "C"), ("member", 3, None)],
                                    "set string, Country_id int, Country_name string")
    members = members.selectExpr("*", "cast(null as string) AS Indicator_id", "cast(null as string) AS Indicator_name", "cast(null as string) AS Source_Table", "cast(null as string) AS Units")

    def lost(*ids):
        pairs = spark.createDataFrame([(n, i) for n, i in enumerate(ids, 1)], "Country_key long, Country_id int")
        none = {"dim_indicator": ("Indicator_key", ["Indicator_id", "Source_Table"]), "dim_unit_of_measure": ("Units_key", ["Measure_Units"])}
        empty = {n: D.Dimension(n, spark.createDataFrame([], ", ".join([f"{k} long", *[f"{c} string" for c in nk]])), k, nk, 0, dict.fromkeys(nk, 0)) for n, (k, nk) in none.items()}
        return unresolved_keys(members, {"dim_country": D.Dimension("dim_country", pairs, "Country_key", ["Country_id"], len(ids)), **empty})["dim_country"]

    assert [lost(1, 2, 3), lost(1), lost(1, 2, 2), lost(7)] == [0, 1, 1, 2]


def test_cells_are_formatted_once_and_laid_out_after_the_shuffle(spark, tmp_path):
    rows = [(1, 1, "A", 1995, 1000.5), (1, 1, "A", 1995, 1.0), (1, 1, "A", 1997, None), (1, 1, None, 1996, 2.0), (None, 2, "R", 2021, 3.25)]
    spark.createDataFrame(rows, "l_suppkey long, l_linenumber int, l_returnflag string, y int, l_extendedprice double").selectExpr(
        "*", "make_date(y, 5, 1) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    cube = lineitem_cube(spark, str(tmp_path))
    assert dict(cube.dtypes)["year_1995"] == "string"
    got = {(r[0], r[1], r[2]): {c: v for c, v in r.asDict().items() if c.startswith("year_") and v != ".."} for r in cube.collect()}
    assert got == {(1, 1, "A"): {"year_1995": "1,001.50"}, (1, 1, None): {"year_1997": "2.00"}, (None, 2, "R"): {"year_2022": "3.25"}}


def test_cells_parse_as_before(spark):
    want = {"..": None, "": None, " ": None, " .. ": None, None: None, "1,234.505": Decimal("1234.51"), " 7 ": Decimal("7.00"), "..5": Decimal("5.00"),
            "1.,.5": None, "1E5": None, "-3.": Decimal("-3.00"), ",": None, "x": None, "...5": Decimal("0.50")}
    df = spark.createDataFrame([(k,) for k in want], "c string")
    assert {r["c"]: r["v"] for r in df.select("c", parse_numeric_text("c").alias("v")).collect()} == want


@pytest.mark.parametrize("spec", TABLES, ids=lambda t: t.stem)
def test_clean_projections_are_compiled(spark, tmp_dir, spec):
    spark.createDataFrame([], spec.raw_schema()).write.parquet(f"{tmp_dir}/raw")
    raw = spark.read.schema(spec.raw_schema()).parquet(f"{tmp_dir}/raw")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")      # nothing falls back, so the sizes are shown
    try:
        shown = spark._jvm.PythonSQLUtils.explainString(clean_table(raw, spec)._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) < METHOD_BYTES


def test_year_cells_keep_their_columns(spark):
    spec = next(t for t in TABLES if t.stem == "domestic_accommodation")
    years = [c for c in spec.raw_schema().fieldNames() if c.startswith("year_")]
    given = {"year_1995": "1,234.5", "year_1997": " 7 ", years[-1]: "1E5", years[-2]: "..", years[-3]: "", years[-4]: "1..5"}
    raw = spark.createDataFrame([tuple({"C": "8", "S": "2,2", "Basic_data": "ITALY", "Unnamed_5": " a ", "Unnamed_6": " ", "Units": "u", **given}.get(c) for c in spec.raw_schema().fieldNames())],
                                spec.raw_schema())
    row = clean_table(raw, spec).first().asDict()
    assert (row["Country_code"], row["Indicator_code"], row["Country"], row["Indicator_L1"], row["Indicator_L2"], row["Units"]) == (8, "2.20", "ITALY", "a", None, "u")
    filled = {"year_1995": Decimal("1234.50"), "year_1997": Decimal("7.00"), years[-4]: Decimal("15.00")}
    assert {c: v for c, v in row.items() if c.startswith("year_") and v is not None} == filled
