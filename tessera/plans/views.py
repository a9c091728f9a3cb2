"""The star as catalog views over the clean tables: nothing but keys is stored.

``create_views`` renders, from the table specs, a view for each dimension and fact;
they answer from the clean tables as they are, so a reload of the clean layer shows
at once. Surrogate keys can't be a view (numbering all members on every query is
a global sort, and numbers would move), so they are kept in key maps, one small
table a dimension: natural key, surrogate key. ``refresh_keys`` numbers natural keys
that are new since the last refresh, after those that are there; a key once given
stays. After the first refresh keys are those of the loaded tables.

A member that the maps don't know yet has NULL as its key in the views until
the next refresh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.conform import conform_units
from tessera.functions.text import collated, exact
from tessera.operators import dims as D
from tessera.operators.keys import dense_key
from tessera.plans.gold import FACT_NAMES, natural_members
from tessera.plans.pipeline import Warehouse
from tessera.sources.sinks import create_namespaces, point_table, write_version
from tessera.specs import CLEAN_YEARS, COLLATION, LABEL_RULES, SERIES_RULES, UNIT_RULES, year_col

#: Key maps: table, surrogate key, natural key, and the columns new keys are numbered by (as the loaded dimensions are).
MAPS = {
    "key_country": ("Country_key", ("Country_id",), ("Country_id",)),
    "key_indicator": ("Indicator_key", ("Indicator_id", "Source_Table"), ("Indicator_id", "Indicator_name", "Source_Table")),
    "key_year": ("Year_key", ("Year",), ("Year",)),
    "key_unit": ("Units_key", ("Measure_Units",), ("Measure_Units",)),
}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _natural_keys(wh: Warehouse) -> dict[str, DataFrame]:
    """Natural keys in the clean tables, one row each, with the columns they are numbered by."""
    silver = wh.silver()
    members = natural_members(silver, wh.tables)
    of = lambda kind, *cols: members.where(F.col("set") == kind).select(*cols).dropna()
    wide = [silver[t.stem] for t in wh.tables if t.stem in silver and t.shape == "wide"]
    years = of("year", "Year")
    if wide:
        years = years.union(wh.spark.createDataFrame([(y,) for y in CLEAN_YEARS], "Year int"))
    units = of("unit", "Units").select(conform_units("Units").alias("Measure_Units"))
    return {"key_country": D.least_name(of("member", "Country_id", "Country_name"), ["Country_id"], "Country_name").select("Country_id"),
            "key_indicator": D.least_name(of("indicator", "Indicator_id", "Indicator_name", "Source_Table"), ["Indicator_id", "Source_Table"], "Indicator_name"),
            "key_year": years.distinct(), "key_unit": D.distinct_collated(units)}


def refresh_keys(wh: Warehouse) -> dict[str, int]:
    """Number the natural keys that the maps don't know; gives how many there were, by map."""
    spark, added = wh.spark, {}
    for name, found in _natural_keys(wh).items():
        key, natural, order = MAPS[name]
        text = [c for c in order if found.schema[c].dataType.typeName() == "string"]
        table, top, old = wh.name("gold", name), 0, None
        if spark.catalog.tableExists(table):
            old = spark.table(table).checkpoint(eager=True)
            top = old.agg(F.max(key)).first()[0] or 0
            same = [(collated(f"o.{c}") == collated(f"n.{c}")) if c in text else F.col(f"o.{c}") == F.col(f"n.{c}") for c in natural]
            found = found.alias("n").join(old.alias("o"), same, "left_anti")
        new = dense_key(found, [exact(c) if c in text else F.col(c) for c in order], key)
        added[name] = new.rows
        if new.rows or old is None:
            rows = new.df.select((F.col(key) + top).alias(key), *[collated(c).alias(c) if c in text else F.col(c) for c in natural])
            path = write_version(rows if old is None else old.unionByName(rows), wh.root, table)
            point_table(spark, table, path)
    return added


def _label(code: str, label: str) -> str:
    cases = " ".join(f"WHEN {code} = {_text(k)} THEN " + (f"concat({label}, {_text(t)})" if mode == "suffix" else _text(t)) for k, mode, t in LABEL_RULES)
    return f"CASE {cases} ELSE {label} END"


def _units(c: str) -> str:
    cases = " ".join(f"WHEN upper({c}) = {_text(a)} THEN {_text(b)}" for a, b in UNIT_RULES)
    return f"CASE {cases} ELSE upper({c}) END"


def _series(c: str) -> str:
    cases = " ".join("WHEN " + (f"upper({c}) = {_text(t.upper())}" if kind == "eq" else f"startswith(upper({c}), {_text(t.upper())})") + f" THEN {_text(out)}"
                     for kind, t, out in SERIES_RULES)
    return f"CASE {cases} ELSE {c} END"


def _plain(c: str) -> str:
    return f"{c} COLLATE UTF8_BINARY"


def view_definitions(wh: Warehouse) -> dict[str, str]:
    """SELECT statement of every view, by name, over the clean tables and key maps that are there."""
    specs = [t for t in wh.tables if wh.spark.catalog.tableExists(wh.name("silver", t.stem))]
    wide, long = [t for t in specs if t.shape == "wide"], [t for t in specs if t.shape == "long"]
    table = lambda t: wh.name("silver", t.stem)
    keys = {m: wh.name("gold", m) for m in MAPS}
    tag = lambda t: f"{_text(t.tag)} COLLATE {COLLATION}"
    out = {}
    names = " UNION ALL ".join(f"SELECT Country_code, Country FROM {table(t)}" for t in specs)
    out["dim_country"] = f"""
SELECT k.Country_key, k.Country_id, n.Country_name COLLATE {COLLATION} AS Country_name
FROM {keys['key_country']} k JOIN (SELECT Country_code, min({_plain('Country')}) AS Country_name FROM ({names})
                                   WHERE Country_code IS NOT NULL AND Country IS NOT NULL GROUP BY Country_code) n ON k.Country_id = n.Country_code"""
    if wide:
        label = "coalesce(upper(Indicator_L1), upper(Indicator_L2), upper(Indicator_L3), upper(Indicator_L4))"
        labels = " UNION ALL ".join(f"SELECT Indicator_code, {_label('Indicator_code', label)} AS label, {tag(t)} AS tag FROM {table(t)}" for t in wide)
        out["dim_indicator"] = f"""
SELECT k.Indicator_key, k.Indicator_id, n.Indicator_name COLLATE {COLLATION} AS Indicator_name, k.Source_Table
FROM {keys['key_indicator']} k JOIN (SELECT Indicator_code, tag, min({_plain('label')}) AS Indicator_name FROM ({labels})
                                     WHERE Indicator_code IS NOT NULL AND label IS NOT NULL GROUP BY Indicator_code, tag) n
ON k.Indicator_id = n.Indicator_code AND k.Source_Table = n.tag"""
    out["dim_year"] = f"SELECT Year_key, Year FROM {keys['key_year']}"
    out["dim_unit_of_measure"] = f"SELECT Units_key, Measure_Units FROM {keys['key_unit']}"
    years = ", ".join(map(year_col, CLEAN_YEARS))
    for fact, name in FACT_NAMES.items():
        if fact == "sdg":
            continue
        own = [t for t in wide if t.fact == fact]
        if own:
            rows = " UNION ALL ".join(f"SELECT Country_code, Indicator_code, {tag(t)} AS tag, {_units('Units')} AS unit, {years} FROM {table(t)}" for t in own)
            out[name] = f"""
SELECT Country_key, Indicator_key, y.Year_key, Units_key, Value FROM (
  SELECT Country_key, Indicator_key, Units_key, {years} FROM ({rows}) r
  LEFT JOIN {keys['key_country']} c ON r.Country_code = c.Country_id
  LEFT JOIN {keys['key_indicator']} i ON r.Indicator_code = i.Indicator_id AND r.tag = i.Source_Table
  LEFT JOIN {keys['key_unit']} u ON r.unit = u.Measure_Units
) UNPIVOT (Value FOR period IN ({years})) v
LEFT JOIN {keys['key_year']} y ON CAST(right(v.period, 4) AS INT) = y.Year"""
    if long:
        rows = " UNION ALL ".join(f"SELECT Country_code, {_series('SeriesDescription')} AS Indicator, year(Time_Period) AS yr, {_units('Units')} AS unit, Value FROM {table(t)}"
                                  for t in long)
        out[FACT_NAMES["sdg"]] = f"""
SELECT Country_key, Indicator, Year_key, Units_key, Value FROM ({rows}) r
LEFT JOIN {keys['key_country']} c ON r.Country_code = c.Country_id
LEFT JOIN {keys['key_year']} y ON r.yr = y.Year
LEFT JOIN {keys['key_unit']} u ON r.unit = u.Measure_Units"""
    return out


def create_views(wh: Warehouse, namespace: str = "star") -> list[str]:
    """Create or replace the views in a namespace of their own; number new keys first. Gives the views' names."""
    refresh_keys(wh)
    create_namespaces(wh.spark, [namespace], wh.prefix)
    names = []
    for name, select in view_definitions(wh).items():
        names.append(wh.name(namespace, name))
        wh.spark.sql(f"CREATE OR REPLACE VIEW {names[-1]} AS {select}")
    return names
