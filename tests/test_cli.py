"""The load command: all layers, the audit, then every quality check."""

import contextlib
import io
import os

from tessera.__main__ import main
from tests.test_pipeline import build_inputs


def test_missing_extracts_fail(spark, tmp_dir):
    build_inputs(os.path.join(tmp_dir, "in"))
    assert main(["load", os.path.join(tmp_dir, "nothing"), os.path.join(tmp_dir, "root")]) == 2
    assert main(["load", "file://" + os.path.join(tmp_dir, "nothing"), os.path.join(tmp_dir, "root"), "--allow-missing"]) == 2
    assert not os.path.exists(os.path.join(tmp_dir, "root"))


def test_settings_of_the_session_stay(spark):
    from tessera.session import build_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "777")
    try:
        assert build_session("local[2]").conf.get("spark.sql.shuffle.partitions") == "777"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_load_and_check(spark, tmp_dir):
    build_inputs(os.path.join(tmp_dir, "in"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert main(["load", os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "root"),
                     "--check", "--max-reject-fraction", "0.5", "--parallelism", "2"]) == 0
    out = buf.getvalue()
    assert "fact_inbound_tourism" in out and "dim_country" in out        # audit rows
    checks = {line.split()[0]: int(line.split()[-1]) for line in out.splitlines()
              if line.startswith(("fk:", "dim_unique:", "duplicates:"))}
    assert checks["fk:fact_sdg"] == 3 and checks["fk:fact_domestic_tourism"] == 0
    assert len([k for k in checks if k.startswith("duplicates:")]) == 14
