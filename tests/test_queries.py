"""Every registered query against its DuckDB oracle on the smallest driver tables
(the same compare the correctness gate runs at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_registered_with_oracle_or_rows_only():
    # the optional training-data queries that SQL cannot express are tested in their own folder
    rows_only = {n for n in QUERIES if n == "pipeline" or n.startswith("op")}
    assert set(ORACLE) <= set(QUERIES) <= set(ORACLE) | rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Country_key", "Indicator_key", "Year_key", "Units_key", "Value"]
    assert df.count() > 0


def test_rows_only_queries(spark):
    audit = QUERIES["load_audit"](spark, SF).collect()
    assert len(audit) == 42 and all(r.status == "ok" for r in audit)
    scan = QUERIES["csv_scan_roundtrip"](spark, SF)
    assert scan.filter("_reject_reason is not null").count() > 0


@pytest.mark.parametrize("name", ["fact_star_4dim", "dq_fk_4dim", "mart_flat"])
def test_star_queries_without_broadcast(spark, duck, name):
    """Over the broadcast budget the same queries plan sort-merge joins and
    still match the oracle."""
    import contextlib
    import io

    spark.conf.set("tessera.broadcast.maxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, SF)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "SortMergeJoin" in buf.getvalue() and "BroadcastHashJoin" not in buf.getvalue()
        cur = duck.execute(ORACLE[name])
        dcols = [d[0] for d in cur.description]
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(dcols, cur.fetchall())[0]
    finally:
        spark.conf.unset("tessera.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
