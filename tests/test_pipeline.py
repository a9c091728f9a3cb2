"""Golden run of the raw -> clean -> star load on small synthetic extracts."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera import specs
from tessera.operators import quality as Q
from tessera.plans.gold import GoldOptions, build_star
from tessera.plans.pipeline import RejectThresholdExceeded, Warehouse

YEARS = specs.RAW_YEARS


def wide_line(spec, c, s, country, levels, units, cells, series="TF", extra=None):
    vals = [c, s, f"{c}_{s}", country, *levels, units, ""]
    if spec.with_series:
        vals.append(series)
    row = {y: ".." for y in YEARS}
    row.update(cells)
    vals += [row[y] for y in YEARS] + [""]
    if extra is not None:
        vals.append(extra)
    return ";".join(vals)


def long_line(code, name, period, value, desc, units):
    return ";".join(["1", "8.9.1", "ST", desc, code, name, period, value, "src", "", "C", units])


def write(path, header, lines, eol="\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + eol + eol.join(lines) + eol)


def build_inputs(root):
    inputs = {}
    gdp = specs.SERIES_RULES[0][1]
    for spec in specs.TABLES:
        path = os.path.join(root, spec.file_name)
        header = ";".join(spec.raw_schema().fieldNames())
        if spec.shape == "long":
            lines = [long_line("534", "Côte d'Ivoire", "2015", "12.345", gdp, "PERCENT"),
                     long_line("380", "Italy", "2016", "1,234", gdp, "PERCENT"),
                     long_line("231", "Ethiopia", "x", "..", gdp, "NUMBER")]
        else:
            lines = [
                wide_line(spec, "380", "22", " ITALY ", ["", "guests", "", ""], "Units",
                          {1995: "1,234.5", 2020: "7"}),
                wide_line(spec, "724", "219", "SPAIN", ["Nights spent", "", "", ""], "Nights",
                          {1997: "..", 2022: "1.005"}),
                wide_line(spec, "", "", '"The information is provisional', ["", "", "", ""], "", {}),
                wide_line(spec, "380", "22", "ITALY", ["", "guests", "", ""], "Units", {}, extra="stray"),
                wide_line(spec, "250", "1,1", 'FRANCE "the;republic"', ["x", "", "", ""], "Units", {1998: "3"}),
            ]
        write(path, header, lines, eol="\r\n" if spec.stem == "domestic_trip" else "\n")
        inputs[spec.stem] = path
    return inputs


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    inputs = build_inputs(os.path.join(root, "in"))
    wh = Warehouse(spark, os.path.join(root, "tables"), max_reject_fraction=0.5, parallelism=3)
    star = wh.run(inputs)
    return wh, star, inputs, root


def test_audit_rows(warehouse):
    wh, _, _, _ = warehouse
    audit = wh.audit_frame().collect()
    assert len(audit) == 14 + 14 + 4 + 2 + 5 + 3     # dimensions, aliases, facts; a row for each layer
    assert all(r.started <= r.ended for r in audit)
    assert all(r.status == "ok" for r in audit)
    raw = {r.table_name: (r.rows, r.rejects) for r in audit if r.layer == "raw"}
    assert raw["domestic_accommodation"] == (5, 2)     # extra field, quoted ';'
    assert raw["domestic_trip"] == (5, 2)              # CRLF line ends read the same
    assert raw["sdg_891"] == (3, 0)
    clean = {r.table_name: r.rows for r in audit if r.layer == "clean"}
    assert clean == {t: rows - rejects for t, (rows, rejects) in raw.items()}   # cleaning keeps rows


def test_rejects_are_kept_with_reasons(spark, warehouse):
    wh, _, _, _ = warehouse
    rej = wh.rejects().filter("table_name = 'domestic_accommodation'").collect()
    assert len(rej) == 2 and {r._reject_reason for r in rej} == {"field_count"}
    assert any(r._raw_line.endswith(";stray") for r in rej)


def test_clean_values(spark, warehouse):
    da = spark.table("silver.domestic_accommodation").orderBy("Country_code").collect()
    assert len(da) == 3
    it = [r for r in da if r.Country_code == 380][0]
    assert it.Indicator_code == "2.2" and it.Country == "ITALY" and it.Indicator_L2 == "guests"
    assert it.year_1995 == Decimal("1234.50") and it.year_2020 == Decimal("7.00") and it.year_1996 is None
    es = [r for r in da if r.Country_code == 724][0]
    assert es.Indicator_code == "2.19" and es.year_2022 == Decimal("1.01") and es.year_1997 is None
    noise = [r for r in da if r.Country_code is None][0]
    assert noise.Country is None and noise.Indicator_code is None
    tr = spark.table("silver.inbound_transport").filter("Country_code = 380").collect()[0]
    assert tr.Series_method == "TF"
    sdg = {r.Country_code: r for r in spark.table("silver.sdg_12b1").collect()}
    assert sdg[663].Country == "COTE D'IVOIRE" and sdg[663].Value == Decimal("12.35")
    assert sdg[380].Value is None                      # '1,234' stays NULL, as coded
    assert sdg[288].Country == "GHANA" and sdg[288].Time_Period is None
    assert {r.Country_code for r in spark.table("silver.sdg_891").collect()} == {663, 380, 230}


def test_dims_dense_and_unique(spark, warehouse):
    _, star, _, _ = warehouse
    for d in star.dims.values():
        keys = sorted(r[0] for r in d.df.select(d.key).collect())
        assert keys == list(range(1, d.rows + 1))
        assert Q.dim_key_unique(d).count() == 0
    units = {r.Measure_Units for r in spark.table("gold.dim_unit_of_measure").collect()}
    assert units == {"NUMBER", "AVG_NIGHTS", "PERCENT"}
    years = [r.Year for r in spark.table("gold.dim_year").orderBy("Year_key").collect()]
    assert years == list(range(1995, 2023))
    ind = {(r.Indicator_id, r.Indicator_name) for r in spark.table("gold.dim_indicator").collect()}
    assert ("2.19", "NIGHTS SPENT (ACCOMMODATION)") in ind and ("2.2", "GUESTS") in ind


def test_fact_rows_equal_filled_cells(spark, warehouse):
    cells = 0
    for t in ("domestic_accommodation", "domestic_trip"):
        df = spark.table(f"silver.{t}")
        cells += sum(df.filter(F.col(specs.year_col(y)).isNotNull()).count() for y in specs.CLEAN_YEARS)
    fact = spark.table("gold.fact_domestic_tourism")
    assert fact.count() == cells
    assert fact.filter("Value is null").count() == 0


def test_sdg_fact_keeps_nulls_and_labels(spark, warehouse):
    f = spark.table("gold.fact_sdg").collect()
    assert len(f) == 9
    assert {r.Indicator for r in f} == {"SDG_8.9.1_GDP"}
    assert sum(r.Value is None for r in f) == 6
    assert sum(r.Year_key is None for r in f) == 3     # period 'x'


def test_fk_checks_report_noise_rows(spark, warehouse):
    _, star, _, _ = warehouse
    fact = spark.table("gold.fact_inbound_tourism")
    bad = Q.fk_violations(fact, list(star.dims.values()))
    assert bad.count() == 0            # noise rows carry no values, so no facts


def test_literal_options(spark, warehouse):
    wh, _, _, _ = warehouse
    literal = build_star(wh.silver(), GoldOptions(dedupe_country=False, dedupe_year=False,
                                                  conform_fact_units=False, indicator_on_source=False))
    c = literal.dims["dim_country"]
    assert c.rows > star_rows(warehouse, "dim_country")
    # facts fan out against the literal dimension; unconformed units miss the dimension
    dom = literal.facts["fact_domestic_tourism"]
    assert dom.count() > spark.table("gold.fact_domestic_tourism").count()
    assert dom.filter("Units_key is null").count() > 0
    ind = literal.facts["fact_tourism_industries"]
    assert ind.filter("Units_key is null").count() == 0


def star_rows(warehouse, name):
    return warehouse[1].dims[name].rows


def test_reject_threshold_keeps_previous_version(spark, warehouse, tmp_path):
    wh, _, inputs, root = warehouse
    before = spark.table("bronze.raw_domestic_trip").count()
    bad = str(tmp_path / "bad.csv")
    spec = specs.TABLES_BY_STEM["domestic_trip"]
    write(bad, ";".join(spec.raw_schema().fieldNames()), ["a;b"] * 10)
    strict = Warehouse(spark, os.path.join(root, "tables"), tables=(spec,), max_reject_fraction=0.05)
    with pytest.raises(RejectThresholdExceeded):
        strict.load_raw({"domestic_trip": bad})
    assert strict.audit[-1].status == "failed"
    assert spark.table("bronze.raw_domestic_trip").count() == before


def test_define_tables_then_load(spark, tmp_path):
    spec = specs.TABLES_BY_STEM["sdg_892"]
    wh = Warehouse(spark, str(tmp_path / "tables"), tables=(spec,))
    wh.define(replace=True)
    assert spark.table("silver.sdg_892").schema.fieldNames() == spec.clean_schema().fieldNames()
    assert spark.table("silver.sdg_892").count() == 0
    path = str(tmp_path / "sdg.csv")
    write(path, ";".join(spec.raw_schema().fieldNames()),
          [long_line("276", "Germany", "2020", "3.5", specs.SERIES_RULES[1][1], "NUMBER")])
    wh.load_raw({"sdg_892": path})
    wh.load_clean()
    row = spark.table("silver.sdg_892").collect()[0]
    assert (row.Country_code, row.Country, str(row.Value)) == (280, "GERMANY", "3.50")


def test_fact_partitioning_option(spark, warehouse, tmp_path):
    wh, _, _, _ = warehouse
    part = Warehouse(spark, str(tmp_path / "tables"), fact_partition_by=("Year_key",))
    part.audit = []
    star = build_star(wh.silver())
    from tessera.sources.sinks import publish
    path = publish(spark, star.facts["fact_outbound_tourism"], "gold.fact_outbound_part",
                   str(tmp_path / "tables"), partition_by=list(part.fact_partition_by))
    assert any(p.startswith("Year_key=") for p in os.listdir(path))
    assert spark.table("gold.fact_outbound_part").count() == spark.table("gold.fact_outbound_tourism").count()


def test_quality_report_over_loaded_tables(spark, warehouse):
    from tessera.plans.checks import quality_report
    summary, checks = quality_report(spark)
    got = {r["check"]: r["violations"] for r in summary.collect()}
    # ' ITALY ' is trimmed by the cleaning, so no blanks survive; the wide
    # rows of ITALY share (country, code, units) in every table: duplicates
    assert got["blanks:domestic_accommodation"] == 0
    assert got["duplicates:domestic_accommodation"] == 0
    assert got["charset:sdg_891"] == 1                 # COTE D'IVOIRE has an apostrophe
    assert got["id_conflict:domestic_accommodation~sdg_12b1"] == 0
    assert all(got[f"dim_unique:{d}"] == 0 for d in
               ("dim_indicator", "dim_year", "dim_unit_of_measure"))
    assert got["fk:fact_sdg"] == 3                     # period 'x' has no year key
    assert set(k for k in got if k.startswith("fk:")) == {
        "fk:fact_domestic_tourism", "fk:fact_inbound_tourism", "fk:fact_outbound_tourism",
        "fk:fact_tourism_industries", "fk:fact_sdg"}


def test_quote_modes(spark, tmp_path):
    """Quotes kept as data (default): a ';' inside quotes splits the line, which
    is then rejected. Quotes as text qualifiers: the field stays whole and the
    unquoted header note is still recognised as noise."""
    spec = specs.TABLES_BY_STEM["outbound_departures"]
    path = str(tmp_path / "od.csv")
    write(path, ";".join(spec.raw_schema().fieldNames()), [
        wide_line(spec, "1", "11", '"The information; provisional"', ["a", "", "", ""], "Units", {2000: "5"}),
        wide_line(spec, "2", "11", '"SPAIN"', ["a", "", "", ""], "Units", {2000: "6"}),
    ])
    plain = Warehouse(spark, str(tmp_path / "t1"), tables=(spec,), max_reject_fraction=1.0)
    plain.load_raw({spec.stem: path})
    assert plain.audit[-1].rejects == 1
    plain.load_clean()
    assert [r.Country for r in spark.table("silver.outbound_departures").collect()] == ['"SPAIN"']
    quoted = Warehouse(spark, str(tmp_path / "t2"), tables=(spec,), quote='"')
    quoted.load_raw({spec.stem: path})
    assert quoted.audit[-1].rejects == 0
    quoted.load_clean()
    got = {r.Country_code: r.Country for r in spark.table("silver.outbound_departures").collect()}
    assert got == {1: None, 2: "SPAIN"}


def test_salted_star_without_broadcast_matches(spark, warehouse):
    wh, _, _, _ = warehouse
    # both builds read the same silver snapshot (other tests re-point tables)
    silver = {k: v.cache() for k, v in wh.silver().items()}
    default = build_star(silver)
    want = {n: sorted(map(tuple, default.facts[n].collect()), key=str)
            for n in ("fact_inbound_tourism", "fact_sdg")}
    spark.conf.set("tessera.broadcast.maxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = build_star(silver, GoldOptions(salt_buckets=4))
        for name, rows in want.items():
            assert sorted(map(tuple, star.facts[name].collect()), key=str) == rows
    finally:
        spark.conf.unset("tessera.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def one_spec(tmp_path, stem, lines):
    spec = specs.TABLES_BY_STEM[stem]
    path = str(tmp_path / f"{stem}.csv")
    write(path, ";".join(spec.raw_schema().fieldNames()), lines)
    return spec, path


def test_failed_star_load_leaves_all_old_tables(spark, warehouse, tmp_path, monkeypatch):
    from tessera.plans import pipeline
    from tessera.sources.sinks import table_location
    inputs = warehouse[2]
    wh = Warehouse(spark, str(tmp_path / "t"), max_reject_fraction=0.5, parallelism=3, prefix="atomic_")
    wh.run(inputs)
    names = list(wh.read_star())
    assert len(names) == 11
    before = {n: table_location(spark, wh.name("gold", n)) for n in names}
    assert len({p.rsplit("/", 1)[-1] for p in before.values()}) == 1
    write_one, point_one = pipeline.write_version, pipeline.move_pointers.__globals__["point_table"]

    def no_fact(df, root, table, **kw):
        if table.endswith("fact_sdg"):
            raise OSError("disk full")
        return write_one(df, root, table, **kw)
    monkeypatch.setattr(pipeline, "write_version", no_fact)
    with pytest.raises(OSError):
        wh.load_star()
    assert {n: table_location(spark, wh.name("gold", n)) for n in names} == before
    failed = [a for a in wh.audit if a.status == "failed"]
    assert {a.table_name for a in failed} == {"fact_sdg", "*"}
    assert (failed[0].error, failed[0].error_class, failed[0].error_condition, failed[0].error_procedure) == \
        ("OSError: disk full", "OSError", "-", "no_fact")

    # a swap that fails half way goes back
    monkeypatch.setattr(pipeline, "write_version", write_one)
    calls = []

    def fifth_fails(spark, table, *a, **kw):
        calls.append(table)
        if len(calls) == 5:
            raise OSError("metastore away")
        return point_one(spark, table, *a, **kw)
    monkeypatch.setitem(pipeline.move_pointers.__globals__, "point_table", fifth_fails)
    with pytest.raises(OSError):
        wh.load_star()
    monkeypatch.setitem(pipeline.move_pointers.__globals__, "point_table", point_one)
    assert {n: table_location(spark, wh.name("gold", n)) for n in names} == before
    star = wh.read_star()
    assert star["fact_sdg"].join(star["dim_country"], "Country_key").count() > 0

    # old versions (two of them failed loads) go, the other warehouse's tables stay
    wh.keep_versions = 1
    wh.load_star()
    folder = os.path.join(str(tmp_path / "t"), "atomic_gold", "dim_country")
    assert len(os.listdir(folder)) == 1
    assert wh.read_star()["fact_sdg"].count() == spark.table("gold.fact_sdg").count() == 9


def test_error_record_has_spark_condition_and_state(spark, tmp_path):
    spec, _ = one_spec(tmp_path, "sdg_892", [])
    wh = Warehouse(spark, str(tmp_path / "t"), tables=(spec,), prefix="errors_")
    with pytest.raises(Exception):
        wh.load_raw({"sdg_892": str(tmp_path / "nowhere.csv")})
    row = wh.audit_frame().where("table_name = 'sdg_892'").first()
    assert row.status == "failed" and row.error_condition == "PATH_NOT_FOUND" and row.error_state == "42K03"
    assert row.error_line.isdigit() and row.error_procedure not in (None, "-")
