"""Column rules on the edge values listed in FIXTURES.md section 4."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera import specs
from tessera.functions import (
    conform_units, first_label, normalize_code, parse_numeric_text, parse_plain_decimal,
    period_to_date, qualify_label, remap_area_code, series_code, standardize_long_name,
    standardize_wide_name, year_from_name,
)
from tessera.functions.text import clean_text, collated_equal, has_nonstandard_char, untrimmed


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_numeric_cells(spark):
    vals = ["..", "", "1,234.5", " 7 ", "1.005", "abc", "1E5", "12345678901234567.0", None, "-3", "1.2.3"]
    out = one_col(spark, vals, parse_numeric_text)
    assert out == [None, None, Decimal("1234.50"), Decimal("7.00"), Decimal("1.01"), None, None,
                   None, None, Decimal("-3.00"), None]


def test_sdg_value_as_coded_and_optional_separator(spark):
    assert one_col(spark, ["12.345", "1,234", ".."], parse_plain_decimal) == [Decimal("12.35"), None, None]
    assert one_col(spark, ["1,234"], lambda c: parse_plain_decimal(c, strip_thousands=True)) == [Decimal("1234.00")]


def test_code_general(spark):
    vals = [None, " ", "3", "22", "219", "110", "2,19", "1.1", "AB"]
    assert one_col(spark, vals, normalize_code) == [None, None, "3", "2.2", "2.19", "1.10", "2.19", "1.1", "A.B"]


@pytest.mark.parametrize("fixes,cases", [
    (specs.CODE_FIX_DOMESTIC_ACCOMMODATION, {"2.2": "2.20", "2,2": "2.20", "22": "2.2"}),
    (specs.CODE_FIX_INBOUND_ACCOMMODATION, {"1.3": "1.30"}),
    (specs.CODE_FIX_INBOUND_REGIONS, {"1.1": "1.10", "11": "1.1"}),
    (specs.CODE_FIX_INBOUND_TRANSPORT, {"12": "1.20", "1.2": "1.2"}),
])
def test_code_table_fixes(spark, fixes, cases):
    keys = list(cases)
    assert one_col(spark, keys, lambda c: normalize_code(c, fixes)) == [cases[k] for k in keys]


def test_country_wide(spark):
    rules = specs.WIDE_NAME_RULES + specs.WIDE_NAME_RULES_INTACT
    vals = ['"The information is provisional"', "Source: UN", "..", "KOREA, REPUBLIC OF",
            "TÜRKIYE", "T┬ÜRKIYE", "COTE D┬┤IVOIRE", "COTE D´IVOIRE", " ITALY ", "Korea, Republic of",
            "KOREA, DEMOCRATIC PEOPLE'S REPUBLIC OF", "CURA├çAO", "CURAÇAO", "Narnia"]
    out = one_col(spark, vals, lambda c: standardize_wide_name(c, rules))
    assert out == [None, None, None, "SOUTH KOREA", "TURKIYE", "TURKIYE", "COTE D'IVOIRE",
                   "COTE D'IVOIRE", "ITALY", "SOUTH KOREA", "NORTH KOREA", "CURACAO", "CURACAO", "Narnia"]


def test_country_long(spark):
    vals = ["Côte d'Ivoire", "Réunion", "Ethiopia", " Republic of Korea ", "", "Curaçao"]
    assert one_col(spark, vals, lambda c: standardize_long_name(c, specs.LONG_NAME_RULES)) == \
        ["COTE D'IVOIRE", "REUNION", "ETHIOPIA", "SOUTH KOREA", None, "CURACAO"]
    assert one_col(spark, ["Ethiopia"], lambda c: standardize_long_name(c, specs.LONG_NAME_RULES_12B1)) == ["GHANA"]


def test_area_code_remap_is_simultaneous(spark):
    vals = ["534", "535", "531", "276", "231", "x", " 100 ", None]
    assert one_col(spark, vals, lambda c: remap_area_code(c, specs.AREA_CODE_REMAP)) == \
        [663, 658, 535, 280, 230, None, 100, None]
    assert one_col(spark, ["231", "531"], lambda c: remap_area_code(c, specs.AREA_CODE_REMAP_12B1)) == [288, 535]


def test_period(spark):
    assert one_col(spark, ["2015", "x", "0", "10000", None], period_to_date) == \
        [date(2015, 1, 1), None, None, None, None]


def test_series_clean(spark):
    assert one_col(spark, ["..", " TF "], clean_text) == [None, "TF"]


def test_labels(spark):
    df = spark.createDataFrame([("2.19", None, "guests"), ("1.4", "x", None), ("9.9", None, None),
                                ("1.5", "arrivals", None)], "code string, l1 string, l2 string")
    out = df.select(qualify_label("code", first_label("l1", "l2")).alias("n")).collect()
    assert [r.n for r in out] == ["GUESTS (ACCOMMODATION)", "CRUISE PASSENGERS", None, "ARRIVALS REGIONS"]


def test_units(spark):
    assert one_col(spark, ["Units", "Nights", "Thousands", None], conform_units) == \
        ["NUMBER", "AVG_NIGHTS", "THOUSANDS", None]


def test_series_codes(spark):
    gdp, emp, pfx = (r[1] for r in specs.SERIES_RULES)
    assert one_col(spark, [gdp, emp, pfx + "tables)", "other"], series_code) == \
        ["SDG_8.9.1_GDP", "SDG_8.9.2_EMP", "SDG_12.b.1_SEEA", "other"]


def test_year_from_column_name(spark):
    assert one_col(spark, ["year_1995", "Country_code", "dwh_create_date"], year_from_name) == [1995, None, None]


def test_checks_helpers(spark):
    assert one_col(spark, ["a ", "a", None], untrimmed) == [True, False, None]
    assert one_col(spark, ["ÉIRE", "ok-name_1"], has_nonstandard_char) == [True, False]
    df = spark.createDataFrame([("a ", "A"), ("x", "y")], "a string, b string")
    assert [r[0] for r in df.select(collated_equal("a", "b")).collect()] == [True, False]
