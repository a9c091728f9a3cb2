"""Lengths declared for the clean columns: over-long rows are set aside, the load stays whole."""

import json

import pytest

from tessera import specs
from tessera.plans.pipeline import RejectThresholdExceeded, Warehouse
from tests.test_pipeline import wide_line, write

SPEC = specs.TABLES_BY_STEM["outbound_departures"]


def load(spark, root, names, share):
    lines = [wide_line(SPEC, str(i), "22", n, ["guests", "", "", ""], "Units", {1995: str(i), 1998: "1"}) for i, n in enumerate(names, 1)]
    write(f"{root}/in.csv", ";".join(SPEC.raw_schema().fieldNames()), lines)
    wh = Warehouse(spark, f"{root}/t", tables=(SPEC,), prefix="len_", max_reject_fraction=share)
    wh.load_raw({SPEC.stem: f"{root}/in.csv"})
    return wh


def test_over_long_rows_are_set_aside(spark, tmp_path):
    names = ["é" * 200, "n" * 201, "x" * 200 + " " * 30, "ITALY"]
    wh = load(spark, str(tmp_path), names, 0.3)
    wh.load_clean()
    assert {r["Country_code"] for r in spark.table("len_silver.outbound_departures").collect()} == {1, 3, 4}
    (bad,) = wh.clean_rejects().collect()
    assert (bad["table_name"], bad["_reject_reason"], json.loads(bad["row"])["Country"]) == (SPEC.stem, "too_long:Country", names[1])
    row = next(a for a in wh.audit if a.layer == "clean" and a.table_name == SPEC.stem)
    assert (row.rows, row.rejects) == (4, 1) and wh.cells == {SPEC.stem: 6}
    star = wh.load_star()
    assert star.facts["fact_outbound_tourism"].count() == 6
    # a later load without such rows leaves no old rejects behind
    again = load(spark, str(tmp_path), names[-1:], 0.0)
    again.load_clean()
    assert again.clean_rejects().count() == 0


def test_too_many_fail_the_load_and_keep_the_old_table(spark, tmp_path):
    load(spark, str(tmp_path), ["ITALY"], 0.0).load_clean()
    wh = load(spark, str(tmp_path), ["n" * 201, "SPAIN"], 0.0)
    with pytest.raises(RejectThresholdExceeded, match="1 of 2 clean rows"):
        wh.load_clean()
    assert [r["Country"] for r in spark.table("len_silver.outbound_departures").collect()] == ["ITALY"]
