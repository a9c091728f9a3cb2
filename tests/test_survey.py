"""Encodings found out file by file; every line numbered as a plain count numbers it."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import specs
from tessera.functions.encoding import PAGES, from_bytes, high_characters, misread, repair_text, to_bytes, utf8_of
from tessera.plans.pipeline import Warehouse
from tessera.sources.delimited import read_delimited
from tessera.sources.survey import file_encodings, numbered_lines, read_surveyed, survey
from tests.test_pipeline import wide_line

WORDS = ["été", "plage", "Köln", "straße", "España", "ITALY", "Curaçao", "x", "ÉTÉ", "déjà vu", "naïve", "Señor", "garçon", "Übermut", "ärger", "l’été"]
#: What a file is written in, and the page it was misread in before.
KINDS = {"a": ("utf-8", None), "b": ("cp1252", None), "c": ("utf-8", "cp437"), "d": ("utf-8", "cp850"), "e": ("utf-8", "cp1252"), "f": ("ascii", None)}
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "xyz"])


def seen_in(text, page):
    return "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in text.encode())


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    rnd, root, want = random.Random(1), str(tmp_path_factory.mktemp("files")), {}
    for name, (encoding, page) in KINDS.items():
        eol = "\r\n" if name in "bd" else "\n"
        words = [w for w in WORDS if w.isascii()] if name == "f" else WORDS
        lines = ["h;i;j"]
        for _ in range(700):
            k = rnd.randint(0, 9)
            lines.append("" if k == 0 else "   " if k == 1 else ";".join(rnd.choice(words) for _ in range(rnd.choice([3, 3, 3, 2, 4]))))
        body = eol.join(seen_in(x, page) if page else x for x in lines) + eol
        with open(f"{root}/{name}.csv", "wb") as f:
            f.write(body.encode(encoding))
        want[name] = lines
    return root, want


@pytest.fixture
def many_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def name_of(path):
    return os.path.basename(path)[0]


def test_repair_of_single_values(spark):
    names = ["CURAÇAO", "COTE D´IVOIRE", "TÜRKIYE", "Réunion", "ITALY", "", "Ærø – “x” €", "日本", None]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    for page in PAGES:
        rows = df.select("s", misread("s", page).alias("m")).select("s", "m", utf8_of("m", page).alias("u"), repair_text("s").alias("intact"),
                                                                    repair_text("m", (page,)).alias("back"), from_bytes(to_bytes("s", page), page).alias("same")).collect()
        for r in rows:
            assert r["m"] == (None if r["s"] is None else seen_in(r["s"], page))
            assert r["intact"] == r["back"] == r["s"]
            assert r["u"] == (r["s"] if r["s"] and not r["s"].isascii() else None)
            assert r["same"] in (r["s"], None) and (r["same"] is not None or r["s"] is None or not r["s"].isascii())
    # the two spellings that the name rules know come back by themselves
    broken = [p for k, p, _ in specs.WIDE_NAME_RULES if not p.isascii()]
    got = spark.createDataFrame([(b,) for b in broken], "s string").select(repair_text("s")).collect()
    assert {r[0] for r in got} == {p for _, p, _ in specs.WIDE_NAME_RULES_INTACT}
    assert all(len(a) == len(b) == 128 for a, b in map(high_characters, PAGES))


def test_encodings_and_numbers_over_many_splits(spark, files, many_splits):
    root, want = files
    found = survey(spark, root)
    assert found.count() > 4 * len(KINDS)
    verdict = {name_of(r["_file"]): r["encoding"] for r in file_encodings(found).collect()}
    assert verdict == {"a": "utf-8", "b": "cp1252", "c": "utf-8 misread as cp437", "d": "utf-8 misread as cp850", "e": "utf-8 misread as cp1252", "f": "utf-8"}
    for budget in (None, 0):
        rows = numbered_lines(spark, root, found, max_broadcast_bytes=budget).collect()
        assert len(rows) == sum(map(len, want.values()))
        assert all(r["_line"].rstrip("\r") == want[name_of(r["_file"])][r["_line_number"] - 1] for r in rows)


def test_rows_equal_those_of_a_scan(spark, files, many_splits, tmp_path):
    root, want = files
    for name, lines in want.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    limits = {"y": 6}
    got = read_surveyed(spark, root, SCHEMA, length_limits=limits)
    plain = read_delimited(spark, str(tmp_path), SCHEMA, length_limits=limits)
    assert Counter(tuple(r) for r in got.drop("_file", "_line_number").collect()) == Counter(tuple(r) for r in plain.collect())
    for r in got.where("_reject_reason is not null").collect():
        line = want[name_of(r["_file"])][r["_line_number"] - 1]
        assert r["_reject_reason"] == ("field_count" if line.count(";") != 2 else "too_long:y") and r["_raw_line"] in (None, line)


def test_files_that_change_end_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n" * 5)
    found = survey(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text("x;y\n" * 6)
    with pytest.raises(Exception, match="not as surveyed"):
        numbered_lines(spark, str(tmp_path), found).collect()
    (tmp_path / "a.csv").write_text("x;y\n" * 5)
    (tmp_path / "b.csv").write_text("x;y\n")
    with pytest.raises(Exception, match="not as surveyed"):
        numbered_lines(spark, str(tmp_path), found).collect()


def test_empty_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("h;i;j\n")
    (tmp_path / "c.csv").write_text("h;i;j\n1;2;3")
    rows = read_surveyed(spark, str(tmp_path), SCHEMA)
    assert [(r["x"], r["_line_number"]) for r in rows.collect()] == [("1", 2)]
    assert read_surveyed(spark, str(tmp_path), SCHEMA, header=False, pages=()).count() == 3


def test_warehouse_reads_oem_files_and_names_rejects(spark, tmp_path):
    """One extract in a code page, one misread; names come out right, and rejects say where they stand."""
    chosen = tuple(specs.TABLES_BY_STEM[s] for s in ("domestic_trip", "inbound_accommodation"))
    inputs = {}
    for spec, (encoding, page) in zip(chosen, (("cp1252", None), ("utf-8", "cp850"))):
        lines = [";".join(spec.raw_schema().fieldNames())]
        lines += [wide_line(spec, "531", "22", "CURAÇAO", ["Séjours à l'hôtel", "", "", ""], "Units", {1995: "1"}), "",
                  wide_line(spec, "384", "22", "COTE D´IVOIRE", ["été", "", "", ""], "Units", {1995: "2"}, extra="stray"),
                  wide_line(spec, "638", "22", "Réunion", ["été", "", "", ""], "Units", {1995: "3"})]
        inputs[spec.stem] = str(tmp_path / spec.file_name)
        with open(inputs[spec.stem], "wb") as f:
            f.write(("\n".join(seen_in(x, page) if page else x for x in lines) + "\n").encode(encoding))
    wh = Warehouse(spark, str(tmp_path / "t"), tables=chosen, prefix="oem_", max_reject_fraction=0.5)
    wh.run(inputs)
    for spec in chosen:
        rows = spark.table(f"oem_silver.{spec.stem}").collect()
        assert {r["Country"] for r in rows} == {"CURACAO", "Réunion"} and {r["Indicator_L1"] for r in rows} == {"Séjours à l'hôtel", "été"}
    bad = {(r["table_name"], os.path.basename(r["_file"]).replace("%20", " "), r["_line_number"]) for r in wh.rejects().collect()}
    assert bad == {(s.stem, s.file_name, 4) for s in chosen}
    plain = Warehouse(spark, str(tmp_path / "p"), tables=chosen[1:], prefix="plain_", max_reject_fraction=0.5, survey=False)
    plain.load_raw({chosen[1].stem: inputs[chosen[1].stem]})
    assert {r["_line_number"] for r in plain.rejects().collect()} == {None}
