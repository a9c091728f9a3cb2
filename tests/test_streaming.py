"""Incremental landing: files arriving in two rounds are cleaned once each."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from tessera import specs
from tessera.streaming import read_landed, start_landing
from tests.test_pipeline import wide_line, write


def test_landing_two_rounds(spark, tmp_dir):
    spec = specs.TABLES_BY_STEM["inbound_transport"]
    header = ";".join(spec.raw_schema().fieldNames())
    inp, out, ckpt = (os.path.join(tmp_dir, p) for p in ("in", "out", "ckpt"))
    write(os.path.join(inp, "a.csv"), header,
          [wide_line(spec, "380", "12", "ITALY", ["Arrivals", "", "", ""], "Units", {2019: "1,000"})])
    q = start_landing(spark, spec, inp, out, checkpoint=ckpt)
    q.awaitTermination(120)
    first = read_landed(spark, out).collect()
    assert [(r.Country_code, r.Indicator_code, str(r.year_2019)) for r in first] == [(380, "1.20", "1000.00")]

    write(os.path.join(inp, "b.csv"), header,
          [wide_line(spec, "724", "13", "SPAIN", ["Arrivals", "", "", ""], "Units", {}),
           wide_line(spec, "1", "1", "BAD", ["", "", "", ""], "", {}, extra="x")])
    with pytest.raises(StreamingQueryException, match="1 of 2 rows rejected"):      # no share allowed
        start_landing(spark, spec, inp, out, checkpoint=ckpt).awaitTermination(120)
    assert read_landed(spark, out).count() == 1
    q = start_landing(spark, spec, inp, out, checkpoint=ckpt, max_reject_fraction=0.5, max_files_per_trigger=1)
    q.awaitTermination(120)
    rows = read_landed(spark, out).collect()
    assert sorted(r.Country_code for r in rows) == [380, 724]     # a.csv not processed again
    assert read_landed(spark, out, "rejects").count() == 1
