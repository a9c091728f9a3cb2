"""Every rule of the rule lists against an outcome typed by hand (the SQL oracles render the lists, these tables don't).

FIXED VALUES: they must equal the source warehouse's; stated in its order.
"""

import pytest
from pyspark.sql import functions as F

from tessera import specs
from tessera.functions import (
    conform_units, normalize_code, qualify_label, remap_area_code, series_code, standardize_long_name, standardize_wide_name,
)

WIDE = {
    "Cote d┬┤Ivoire": "COTE D'IVOIRE",
    "Bolivia, Plurinational State of": "BOLIVIA",
    "Cura├çao": "CURACAO",
    "Hong Kong, China": "HONG KONG",
    "Korea, Democratic People's Republic of": "NORTH KOREA",
    "Korea, Republic of": "SOUTH KOREA",
    "Lao People´s Democratic Republic": "LAOS",
    "Macao, China": "MACAO",
    "Micronesia, Federated States of": "MICRONESIA",
    "Moldova, Republic of": "MOLDOVA",
    "Sint Maarten (Dutch part)": "SINT MAARTEN",
    "Tanzania, United Republic of": "TANZANIA",
    "Timor-Leste": "TIMOR EST",
    "Venezuela, Bolivarian Republic of": "VENEZUELA",
    "Türkiye": "TURKIYE",
    "Czech Republic (Czechia)": "CZECHIA",
    "Congo, Democratic Republic of the": "DEMOCRATIC REPUBLIC OF CONGO",
    "Iran, Islamic Republic of": "IRAN",
    "Syrian Arab Republic": "SYRIA",
    "Taiwan Province of China": "TAIWAN",
}
LONG = {
    "Côte d'Ivoire": "COTE D'IVOIRE",
    "China, Hong Kong Special Administrative Region": "HONG KONG",
    "China, Macao Special Administrative Region": "MACAO",
    "Micronesia (Federated States of)": "MICRONESIA",
    "Netherlands (Kingdom of the)": "NETHERLANDS",
    "Réunion": "REUNION",
    "Türkiye": "TURKIYE",
    "United Kingdom of Great Britain and Northern Ireland": "UNITED KINGDOM",
    "Republic of Korea": "SOUTH KOREA",
    "Democratic Republic of the Congo": "DEMOCRATIC REPUBLIC OF CONGO",
    "Bolivia (Plurinational State of)": "BOLIVIA",
    "Bonaire, Sint Eustatius and Saba": "SINT EUSTATIUS",
    "Curaçao": "CURACAO",
    "Iran (Islamic Republic of)": "IRAN",
    "Lao People's Democratic Republic": "LAOS",
    "Sint Maarten (Dutch part)": "SINT MAARTEN",
    "Timor-Leste": "TIMOR EST",
    "Syrian Arab Republic": "SYRIA",
    "Republic of Moldova": "MOLDOVA",
}
LABELS = {
    "2.19": "X (ACCOMMODATION)", "2.20": "X (ACCOMMODATION)",
    "2.21": "X (HOTELS AND SIMILAR ESTABLISHMENTS)", "2.22": "X (HOTELS AND SIMILAR ESTABLISHMENTS)",
    "1.29": "X (ACCOMMODATION)", "1.30": "X (ACCOMMODATION)",
    "1.31": "X (HOTELS AND SIMILAR ESTABLISHMENTS)", "1.32": "X (HOTELS AND SIMILAR ESTABLISHMENTS)",
    "1.14": "X PURPOSE", "1.5": "X REGIONS", "1.19": "X TRANSPORT",
    "1.4": "CRUISE PASSENGERS", "1.13": "NATIONALS RESIDING ABROAD", "9.9": "X",
}


def outcomes(spark, inputs, expr):
    df = spark.createDataFrame([(v,) for v in inputs], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_names_of_the_wide_tables(spark):
    assert len(WIDE) == 20 == len(specs.WIDE_NAME_RULES)
    rules = specs.WIDE_NAME_RULES + specs.WIDE_NAME_RULES_INTACT
    assert outcomes(spark, WIDE, lambda c: standardize_wide_name(c, rules)) == list(WIDE.values())
    assert outcomes(spark, ["cote d´ivoire", "curaçao", "Italy"], lambda c: standardize_wide_name(c, rules)) == ["COTE D'IVOIRE", "CURACAO", "Italy"]


@pytest.mark.parametrize("rules,ethiopia", [(specs.LONG_NAME_RULES, "ETHIOPIA"), (specs.LONG_NAME_RULES_12B1, "GHANA")])
def test_names_of_the_long_tables(spark, rules, ethiopia):
    assert len(LONG) == 19 == len(specs.LONG_NAME_RULES)
    assert outcomes(spark, LONG, lambda c: standardize_long_name(c, rules)) == list(LONG.values())
    assert outcomes(spark, ["Ethiopia", "Italy"], lambda c: standardize_long_name(c, rules)) == [ethiopia, "ITALY"]


def test_labels_units_and_series(spark):
    assert len(LABELS) - 1 == 13 == len(specs.LABEL_RULES)
    assert outcomes(spark, LABELS, lambda c: qualify_label(c, F.lit("X"))) == list(LABELS.values())
    assert outcomes(spark, ["units", "Nights", "thousands"], conform_units) == ["NUMBER", "AVG_NIGHTS", "THOUSANDS"]
    series = {"Tourism direct GDP as a proportion of total GDP (%)": "SDG_8.9.1_GDP",
              "Employed persons in the tourism industries (number)": "SDG_8.9.2_EMP",
              "Implementation of standard accounting tools to monitor the economic and environmental aspects of tourism (SEEA tables)": "SDG_12.b.1_SEEA",
              "Implementation of standard accounting tools": "Implementation of standard accounting tools"}
    assert outcomes(spark, series, series_code) == list(series.values())


def test_codes(spark):
    areas = ["534", "535", "531", "276", "231", "380"]
    assert outcomes(spark, areas, lambda c: remap_area_code(c, specs.TABLES_BY_STEM["sdg_891"].code_remap)) == [663, 658, 535, 280, 230, 380]
    assert outcomes(spark, areas, lambda c: remap_area_code(c, specs.TABLES_BY_STEM["sdg_892"].code_remap)) == [663, 658, 535, 280, 230, 380]
    assert outcomes(spark, areas, lambda c: remap_area_code(c, specs.TABLES_BY_STEM["sdg_12b1"].code_remap)) == [663, 658, 535, 280, 288, 380]
    fixes = {"domestic_accommodation": ("2.2", "2.20"), "inbound_accommodation": ("1.3", "1.30"), "inbound_regions": ("1.1", "1.10"), "inbound_transport": ("12", "1.20")}
    for spec in specs.TABLES:
        if spec.shape == "wide":
            before, after = fixes.get(spec.stem, ("2.2", "2.2"))
            assert outcomes(spark, [before, "219"], lambda c: normalize_code(c, spec.code_fixes)) == [after, "2.19"]
            assert bool(spec.code_fixes) == (spec.stem in fixes)


def test_layouts():
    wide = specs.TABLES_BY_STEM["inbound_arrivals"]
    raw, clean = wide.raw_schema().fieldNames(), wide.clean_schema().fieldNames()
    assert raw[:12] == ["C", "S", "C_and_S", "Basic_data", "Unnamed_5", "Unnamed_6", "Unnamed_7", "Unnamed_8", "Units", "Notes", "Series", "year_1995"]
    assert raw[12:14] == ["year_1997", "year_1998"] and raw[-2:] == ["year_2022", "Unnamed_39"] and len(raw) == 11 + 27 + 1
    assert clean[:10] == ["Country_code", "Indicator_code", "Country", "Indicator_L1", "Indicator_L2", "Indicator_L3", "Indicator_L4", "Units", "Series_method", "year_1995"]
    assert clean[-2:] == ["year_2022", "dwh_create_date"] and len(clean) == 9 + 28 + 1
    assert specs.TABLES_BY_STEM["domestic_trip"].raw_schema().fieldNames()[-1] == "Unnamed_38"
    long = specs.TABLES_BY_STEM["sdg_891"]
    assert len(long.raw_schema()) == 12 and long.clean_schema().simpleString().startswith("struct<Country_code:int,Country:string")
    assert [f.dataType.simpleString() for f in long.clean_schema()][2:4] == ["date", "decimal(18,2)"]
