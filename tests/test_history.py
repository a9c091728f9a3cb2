"""The history of loads: runs add up, retries replace, failures stay, sessions share it."""

import os
import subprocess
import sys

import pytest

from tessera import specs
from tessera.plans.pipeline import AUDIT_SCHEMA, RejectThresholdExceeded, Warehouse
from tessera.sources.history import last_runs, new_run_id, read_history, register, write_layer
from tests.test_pipeline import build_inputs

CHOSEN = tuple(specs.TABLES_BY_STEM[s] for s in ("domestic_trip", "sdg_891"))


def test_two_runs_and_a_failure_read_back_in_a_new_session(spark, tmp_path):
    inputs = build_inputs(str(tmp_path / "in"))
    inputs = {t.stem: inputs[t.stem] for t in CHOSEN}
    root = str(tmp_path / "t")

    def warehouse(run_id, share):
        return Warehouse(spark, root, tables=CHOSEN, prefix="hist_", max_reject_fraction=share, run_id=run_id)

    warehouse("a", 0.5).run(inputs)
    with pytest.raises(RejectThresholdExceeded):
        warehouse("b", 0.0).run(inputs)
    for _ in range(2):
        warehouse("c", 0.5).run(inputs)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        warehouse("d", 0.5).load_raw({"sdg_891": str(tmp_path / "nothing")})
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from tessera.session import build_session\nfrom tessera.plans.pipeline import AUDIT_SCHEMA\nfrom tessera.sources.history import read_history\n"
            "s = build_session('local[2]', shuffle_partitions=2)\n"
            "print([tuple(r) for r in read_history(s, sys.argv[2], AUDIT_SCHEMA).groupBy('run_id', 'layer', 'status').count().collect()])")
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, top, root], capture_output=True, text=True, timeout=240, cwd=str(tmp_path))
    found = {tuple(r) for r in eval(out.stdout.strip().splitlines()[-1])}
    star = 4 + 2 + 2 + 1                       # dimensions, aliases, facts, the layer
    assert found == {(r, layer, "ok", n) for r in "ac" for layer, n in (("raw", 3), ("clean", 3), ("star", star))} | {
        ("b", "raw", "failed", 2), ("d", "raw", "failed", 2)}
    history = read_history(spark, root, AUDIT_SCHEMA)
    assert {r["error_severity"] for r in history.where("status = 'failed'").collect()} == {"input"}
    newest = {(r["layer"], r["table_name"]): r["run_id"] for r in last_runs(history).collect()}
    assert newest["raw", "sdg_891"] == "d" and newest["raw", "domestic_trip"] == "c" and newest["star", "dim_year"] == "c"
    register(spark, root, "hist_gold.load_history", AUDIT_SCHEMA)
    assert spark.sql("SELECT count(*) FROM hist_gold.load_history").first()[0] == history.count()
    warehouse("e", 0.5).load_raw(inputs)
    register(spark, root, "hist_gold.load_history", AUDIT_SCHEMA)
    assert spark.sql("SELECT count(*) FROM hist_gold.load_history WHERE run_id = 'e'").first()[0] == 3


def test_run_ids(spark, tmp_path):
    assert new_run_id() != new_run_id()
    for bad in ("", "a/b", "a=b", "..\\x"):
        with pytest.raises(ValueError):
            write_layer(spark, str(tmp_path), bad, "raw", [], AUDIT_SCHEMA)
    wh = Warehouse(spark, str(tmp_path / "q"), tables=(), prefix="quiet_", history=False)
    wh.load_raw({})
    assert not os.path.exists(tmp_path / "q" / "audit")
