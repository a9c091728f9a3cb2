"""Declarative table specs, schemas and rule lists.

One spec per source table replaces fourteen hand-written loads: the generic
loaders in ``tessera.plans`` read the spec to know the raw layout, the
per-table code fixes, which name rules and code remap apply, and which fact
the table feeds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES. These must equal the source warehouse's values for the
# results to match; they are stated as plain text in their original order.
# ---------------------------------------------------------------------------

# Year range of the wide statistics tables (clean layer); raw files lack 1996.
FIRST_YEAR = 1995
LAST_YEAR = 2022
RAW_MISSING_YEARS = (1996,)

# Country cells that are header / footnote noise (case-insensitive LIKE).
NOISE_PATTERNS = ('"The information%', "Source%")

# Country-name rules for the wide sources, in order; first match wins.
# kind "eq" = equality, "like" = LIKE pattern (both case-insensitive).
WIDE_NAME_RULES = (
    ("eq", "COTE D┬┤IVOIRE", "COTE D'IVOIRE"),
    ("eq", "BOLIVIA, PLURINATIONAL STATE OF", "BOLIVIA"),
    ("eq", "CURA├çAO", "CURACAO"),
    ("eq", "HONG KONG, CHINA", "HONG KONG"),
    ("like", "KOREA, DEMOCRATIC PEOPLE%S REPUBLIC OF", "NORTH KOREA"),
    ("eq", "KOREA, REPUBLIC OF", "SOUTH KOREA"),
    ("like", "LAO PEOPLE%S DEMOCRATIC REPUBLIC", "LAOS"),
    ("eq", "MACAO, CHINA", "MACAO"),
    ("eq", "MICRONESIA, FEDERATED STATES OF", "MICRONESIA"),
    ("eq", "MOLDOVA, REPUBLIC OF", "MOLDOVA"),
    ("eq", "SINT MAARTEN (DUTCH PART)", "SINT MAARTEN"),
    ("eq", "TANZANIA, UNITED REPUBLIC OF", "TANZANIA"),
    ("eq", "TIMOR-LESTE", "TIMOR EST"),
    ("eq", "VENEZUELA, BOLIVARIAN REPUBLIC OF", "VENEZUELA"),
    ("like", "T%RKIYE", "TURKIYE"),
    ("eq", "CZECH REPUBLIC (CZECHIA)", "CZECHIA"),
    ("eq", "CONGO, DEMOCRATIC REPUBLIC OF THE", "DEMOCRATIC REPUBLIC OF CONGO"),
    ("eq", "IRAN, ISLAMIC REPUBLIC OF", "IRAN"),
    ("eq", "SYRIAN ARAB REPUBLIC", "SYRIA"),
    ("eq", "TAIWAN PROVINCE OF CHINA", "TAIWAN"),
)

# Our addition: the intact spellings of the two names the source only knows
# in their mis-decoded form (files read as UTF-8 here).
WIDE_NAME_RULES_INTACT = (
    ("eq", "COTE D´IVOIRE", "COTE D'IVOIRE"),
    ("eq", "CURAÇAO", "CURACAO"),
)

# Country-name rules for the long (SDG) sources, applied to upper(trim(name)).
LONG_NAME_RULES = (
    ("like", "C%TE D'IVOIRE", "COTE D'IVOIRE"),
    ("eq", "CHINA, HONG KONG SPECIAL ADMINISTRATIVE REGION", "HONG KONG"),
    ("eq", "CHINA, MACAO SPECIAL ADMINISTRATIVE REGION", "MACAO"),
    ("eq", "MICRONESIA (FEDERATED STATES OF)", "MICRONESIA"),
    ("eq", "NETHERLANDS (KINGDOM OF THE)", "NETHERLANDS"),
    ("like", "R%UNION", "REUNION"),
    ("like", "T%RKIYE", "TURKIYE"),
    ("eq", "UNITED KINGDOM OF GREAT BRITAIN AND NORTHERN IRELAND", "UNITED KINGDOM"),
    ("eq", "REPUBLIC OF KOREA", "SOUTH KOREA"),
    ("eq", "DEMOCRATIC REPUBLIC OF THE CONGO", "DEMOCRATIC REPUBLIC OF CONGO"),
    ("eq", "BOLIVIA (PLURINATIONAL STATE OF)", "BOLIVIA"),
    ("eq", "BONAIRE, SINT EUSTATIUS AND SABA", "SINT EUSTATIUS"),
    ("like", "CURA%AO", "CURACAO"),
    ("eq", "IRAN (ISLAMIC REPUBLIC OF)", "IRAN"),
    ("like", "LAO PEOPLE%S DEMOCRATIC REPUBLIC", "LAOS"),
    ("eq", "SINT MAARTEN (DUTCH PART)", "SINT MAARTEN"),
    ("eq", "TIMOR-LESTE", "TIMOR EST"),
    ("eq", "SYRIAN ARAB REPUBLIC", "SYRIA"),
    ("eq", "REPUBLIC OF MOLDOVA", "MOLDOVA"),
)

# The third SDG table adds one rule after the list above.
LONG_NAME_RULES_12B1 = LONG_NAME_RULES + (("eq", "ETHIOPIA", "GHANA"),)

# Area-code remaps (applied simultaneously: 531 -> 535 does not go on to 658).
AREA_CODE_REMAP = ((534, 663), (535, 658), (531, 535), (276, 280), (231, 230))
AREA_CODE_REMAP_12B1 = ((534, 663), (535, 658), (531, 535), (276, 280), (231, 288))

# Per-table indicator-code fixes, checked before the general rule.
CODE_FIX_DOMESTIC_ACCOMMODATION = (("2.2", "2.20"),)
CODE_FIX_INBOUND_ACCOMMODATION = (("1.3", "1.30"),)
CODE_FIX_INBOUND_REGIONS = (("1.1", "1.10"),)
CODE_FIX_INBOUND_TRANSPORT = (("12", "1.20"),)

# Indicator label qualification by code: (code, mode, text); mode "suffix"
# appends the text to the label, "replace" replaces the label.
LABEL_RULES = (
    ("2.19", "suffix", " (ACCOMMODATION)"),
    ("2.20", "suffix", " (ACCOMMODATION)"),
    ("2.21", "suffix", " (HOTELS AND SIMILAR ESTABLISHMENTS)"),
    ("2.22", "suffix", " (HOTELS AND SIMILAR ESTABLISHMENTS)"),
    ("1.29", "suffix", " (ACCOMMODATION)"),
    ("1.30", "suffix", " (ACCOMMODATION)"),
    ("1.31", "suffix", " (HOTELS AND SIMILAR ESTABLISHMENTS)"),
    ("1.32", "suffix", " (HOTELS AND SIMILAR ESTABLISHMENTS)"),
    ("1.14", "suffix", " PURPOSE"),
    ("1.5", "suffix", " REGIONS"),
    ("1.19", "suffix", " TRANSPORT"),
    ("1.4", "replace", "CRUISE PASSENGERS"),
    ("1.13", "replace", "NATIONALS RESIDING ABROAD"),
)

# Unit conforming (after upper-casing).
UNIT_RULES = (("UNITS", "NUMBER"), ("NIGHTS", "AVG_NIGHTS"))

# SDG series descriptions to short indicator codes: (kind, text, code).
SERIES_RULES = (
    ("eq", "Tourism direct GDP as a proportion of total GDP (%)", "SDG_8.9.1_GDP"),
    ("eq", "Employed persons in the tourism industries (number)", "SDG_8.9.2_EMP"),
    ("prefix", "Implementation of standard accounting tools to monitor the economic "
               "and environmental aspects of tourism (", "SDG_12.b.1_SEEA"),
)

# Raw file names of the fourteen sources, by table stem.
RAW_FILE_NAMES = {
    "domestic_accommodation": "Domestic Tourism-Accommodation.csv",
    "domestic_trip": "Domestic Tourism-Trips.csv",
    "inbound_accommodation": "Inbound Tourism-Accommodation.csv",
    "inbound_arrivals": "Inbound Tourism-Arrivals.csv",
    "inbound_expenditure": "Inbound Tourism-Expenditure.csv",
    "inbound_purpose": "Inbound Tourism-Purpose.csv",
    "inbound_regions": "Inbound Tourism-Regions.csv",
    "inbound_transport": "Inbound Tourism-Transport.csv",
    "outbound_departures": "Outbound Tourism-Departures.csv",
    "outbound_expenditure": "Outbound Tourism-Expenditure.csv",
    "sdg_891": "SDG 8.9.1.csv",
    "sdg_892": "SDG 8.9.2.csv",
    "sdg_12b1": "SDG 12.b.1.csv",
    "tourism_industries": "Tourism Industries.csv",
}

# Declared text-length limits of the raw columns.
RAW_LENGTH_LIMITS = {
    "C": 20, "S": 20, "C_and_S": 50, "Basic_data": 255,
    "Unnamed_5": 255, "Unnamed_6": 255, "Unnamed_7": 255, "Unnamed_8": 255,
    "Units": 100, "Notes": 255, "Series": 255,
}
YEAR_CELL_LIMIT = 50

# Declared text-length limits of the clean columns, by shape.
CLEAN_LENGTH_LIMITS = {
    "wide": {"Country": 200, "Indicator_L1": 255, "Indicator_L2": 255, "Indicator_L3": 255,
             "Indicator_L4": 255, "Units": 100, "Series_method": 100},
    "long": {"Country": 200, "SeriesDescription": 200, "Nature": 50, "Units": 50},
}

# Columns of the raw layouts, by position: descriptors of the wide tables (the
# year columns follow, then one unused column), and the long tables.
RAW_WIDE_COLUMNS = ("C", "S", "C_and_S", "Basic_data", "Unnamed_5", "Unnamed_6",
                    "Unnamed_7", "Unnamed_8", "Units", "Notes")
RAW_SERIES_COLUMN = "Series"
RAW_LAST_COLUMN, RAW_LAST_COLUMN_WITH_SERIES = "Unnamed_38", "Unnamed_39"
RAW_LONG_COLUMNS = ("Idex", "SDG_Indicator", "SeriesCode", "SeriesDescription",
                    "GeoAreaCode", "GeoAreaName", "TimePeriod", "Value", "Source",
                    "FootNote", "Nature", "Units")

# Columns of the clean layouts around their year columns.
CLEAN_WIDE_COLUMNS = ("Country_code", "Indicator_code", "Country", "Indicator_L1", "Indicator_L2",
                      "Indicator_L3", "Indicator_L4", "Units")
CLEAN_SERIES_COLUMN = "Series_method"
CLEAN_LONG_COLUMNS = ("Country_code", "Country", "Time_Period", "Value", "SeriesDescription",
                      "Nature", "Units")
STAMP_COLUMN = "dwh_create_date"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

CLEAN_YEARS = tuple(range(FIRST_YEAR, LAST_YEAR + 1))
RAW_YEARS = tuple(y for y in CLEAN_YEARS if y not in RAW_MISSING_YEARS)


def year_col(year: int) -> str:
    return f"year_{year}"


def raw_slot(year):
    """The raw year column that holds a data year (Column to Column): the layout
    lacks 1996, so years from there on move up by one. A year without a column
    (null too) ends the job: nothing is left out."""
    from pyspark.sql import functions as F

    slot = F.when(year < RAW_MISSING_YEARS[0], year).otherwise(year + 1)
    return F.when(slot.isin(*RAW_YEARS), slot).otherwise(
        F.raise_error(F.concat(F.lit("no raw year column for "), F.coalesce(year.cast("string"), F.lit("null")))).cast("int"))


def raw_wide_schema(with_series: bool) -> T.StructType:
    names = [*RAW_WIDE_COLUMNS, *[RAW_SERIES_COLUMN] * with_series, *map(year_col, RAW_YEARS),
             RAW_LAST_COLUMN_WITH_SERIES if with_series else RAW_LAST_COLUMN]
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def raw_long_schema() -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in RAW_LONG_COLUMNS])


VALUE_TYPE = T.DecimalType(18, 2)

# How text compares from the clean layer on, as in the source's databases:
# without regard to case and trailing blanks. Columns of this type carry the
# rule to every =, DISTINCT, GROUP BY and join.
COLLATION = "UTF8_LCASE_RTRIM"
TEXT_TYPE = T.StringType(COLLATION)


_CLEAN_TYPES = {"Country_code": T.IntegerType(), "Time_Period": T.DateType(), "Value": VALUE_TYPE, STAMP_COLUMN: T.TimestampType()}


def _clean_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, VALUE_TYPE if n.startswith("year_") else _CLEAN_TYPES.get(n, TEXT_TYPE)) for n in names])


def clean_wide_schema(with_series: bool) -> T.StructType:
    return _clean_schema([*CLEAN_WIDE_COLUMNS, *[CLEAN_SERIES_COLUMN] * with_series, *map(year_col, CLEAN_YEARS), STAMP_COLUMN])


def clean_long_schema() -> T.StructType:
    return _clean_schema([*CLEAN_LONG_COLUMNS, STAMP_COLUMN])


# ---------------------------------------------------------------------------
# Table specs
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class TableSpec:
    stem: str
    shape: str                       # "wide" or "long"
    fact: str                        # fact the table feeds
    with_series: bool = False        # wide tables with a Series column
    code_fixes: tuple = ()           # indicator-code fixes (wide)
    name_rules: tuple = field(default=WIDE_NAME_RULES + WIDE_NAME_RULES_INTACT)
    code_remap: tuple = ()           # area-code remap (long)

    @property
    def file_name(self) -> str:
        return RAW_FILE_NAMES[self.stem]

    @property
    def tag(self) -> str:
        return self.stem.upper()

    def raw_schema(self) -> T.StructType:
        return raw_long_schema() if self.shape == "long" else raw_wide_schema(self.with_series)

    def clean_schema(self) -> T.StructType:
        return clean_long_schema() if self.shape == "long" else clean_wide_schema(self.with_series)


def _wide(stem, fact, series=False, fixes=()):
    return TableSpec(stem, "wide", fact, with_series=series, code_fixes=fixes)


def _long(stem, rules, remap):
    return TableSpec(stem, "long", "sdg", name_rules=rules, code_remap=remap)


TABLES: tuple[TableSpec, ...] = (
    _wide("domestic_accommodation", "domestic", fixes=CODE_FIX_DOMESTIC_ACCOMMODATION),
    _wide("domestic_trip", "domestic"),
    _wide("inbound_accommodation", "inbound", fixes=CODE_FIX_INBOUND_ACCOMMODATION),
    _wide("inbound_arrivals", "inbound", series=True),
    _wide("inbound_expenditure", "inbound", series=True),
    _wide("inbound_purpose", "inbound", series=True),
    _wide("inbound_regions", "inbound", series=True, fixes=CODE_FIX_INBOUND_REGIONS),
    _wide("inbound_transport", "inbound", series=True, fixes=CODE_FIX_INBOUND_TRANSPORT),
    _wide("outbound_departures", "outbound"),
    _wide("outbound_expenditure", "outbound", series=True),
    _long("sdg_891", LONG_NAME_RULES, AREA_CODE_REMAP),
    _long("sdg_892", LONG_NAME_RULES, AREA_CODE_REMAP),
    _long("sdg_12b1", LONG_NAME_RULES_12B1, AREA_CODE_REMAP_12B1),
    _wide("tourism_industries", "industries"),
)

TABLES_BY_STEM = {t.stem: t for t in TABLES}

FACTS = ("domestic", "inbound", "outbound", "sdg", "industries")
