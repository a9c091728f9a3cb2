"""ANSI SQL (DuckDB dialect) for each registered query over the same parquet tables.

The operators are written anew here (CASE ladders, UNION ALL unpivots, ROW_NUMBER
keys, left joins). The texts of the rule lists are not: they are rendered from
``tessera.specs``, so a wrong text would pass on both sides. tests/test_rules.py
holds every rule against an outcome typed by hand.
"""

from __future__ import annotations

from tessera import specs
from tessera.plans.driver import MEASURES, NAME_VOCABULARY, SERIES_BY_EVENT

NUMERIC_RE = r"[+-]?[0-9]*\.?[0-9]*"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rules_sql(x: str, rules) -> str:
    parts = []
    for kind, pattern, out in rules:
        if kind == "eq":
            cond = f"upper({x}) = {lit(pattern.upper())}"
        elif kind == "like":
            cond = f"{x} ILIKE {lit(pattern)}"
        else:
            cond = f"starts_with(upper({x}), {lit(pattern.upper())})"
        parts.append(f"WHEN {cond} THEN {lit(out)}")
    return f"CASE {' '.join(parts)} ELSE {x} END"


def clean_sql(x: str) -> str:
    return f"NULLIF(TRIM(REPLACE({x}, '..', '')), '')"


def noise_sql(x: str) -> str:
    return " OR ".join(f"{x} ILIKE {lit(p)}" for p in specs.NOISE_PATTERNS)


def wide_name_sql(x: str, rules) -> str:
    c = clean_sql(x)
    return rules_sql(f"(CASE WHEN {noise_sql(c)} THEN NULL ELSE {c} END)", rules)


def long_name_sql(x: str, rules) -> str:
    return rules_sql(f"NULLIF(TRIM(UPPER({x})), '')", rules)


def code_sql(raw: str, fixes=()) -> str:
    t = f"TRIM(REPLACE({raw}, ',', '.'))"
    fx = " ".join(f"WHEN {t} = {lit(a)} THEN {lit(b)}" for a, b in fixes)
    return (f"CASE WHEN NULLIF({t}, '') IS NULL THEN NULL {fx} "
            f"WHEN strpos({t}, '.') > 0 THEN {t} "
            f"WHEN length(rtrim({t})) = 1 THEN {t} "
            f"ELSE substr({t}, 1, 1) || '.' || substr({t}, 2) END")


def remap_sql(x: str, mapping) -> str:
    parts = " ".join(f"WHEN {x} = {a} THEN {b}" for a, b in mapping)
    return f"CASE {parts} ELSE {x} END"


def decimal_sql(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, {lit(NUMERIC_RE)}) THEN TRY_CAST({x} AS DECIMAL(18,2)) END"


def units_sql(x: str) -> str:
    u = f"upper({x})"
    parts = " ".join(f"WHEN {u} = {lit(a)} THEN {lit(b)}" for a, b in specs.UNIT_RULES)
    return f"CASE {parts} ELSE {u} END"


def label_sql(code: str, label: str) -> str:
    parts = []
    for key, mode, text in specs.LABEL_RULES:
        out = f"{label} || {lit(text)}" if mode == "suffix" else lit(text)
        parts.append(f"WHEN {code} = {lit(key)} THEN {out}")
    return f"CASE {' '.join(parts)} ELSE {label} END"


def key_sql(key: str, order: str) -> str:
    cols = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in order.split(","))
    return f"CAST(ROW_NUMBER() OVER (ORDER BY {cols}) AS BIGINT) AS {key}"


def event_units_sql() -> str:
    return ("CASE WHEN event_type = 'click' THEN 'Units' WHEN event_type = 'view' THEN 'nights' "
            "ELSE event_type END")


# ---------------------------------------------------------------------------

def numeric_text_parse() -> str:
    return f"""
WITH s AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber = 2 THEN format('{{:,.2f}}', p)
             WHEN l_linenumber = 4 THEN '  ' || CAST(p AS VARCHAR) || ' '
             WHEN l_linenumber = 6 THEN CAST(p AS VARCHAR) || '5'
             ELSE CAST(p AS VARCHAR) END AS raw_value
      FROM s
      UNION ALL
      SELECT l_orderkey, l_linenumber,
        CASE l_linenumber WHEN 3 THEN '..' WHEN 5 THEN '' ELSE '7E3' END
      FROM s WHERE l_linenumber IN (3, 5, 7)),
t AS (SELECT *, NULLIF(TRIM(REPLACE(REPLACE(raw_value, '..', ''), ',', '')), '') AS t FROM r)
SELECT l_orderkey, l_linenumber, raw_value, {decimal_sql('t')} AS value FROM t"""


def text_null_clean() -> str:
    return f"""
WITH r AS (SELECT p_partkey,
             CASE p_partkey % 5 WHEN 0 THEN '  ' || p_name || ' '
                  WHEN 2 THEN p_name || '..' ELSE p_name END AS raw_name
           FROM part
           UNION ALL
           SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN '..' ELSE '   ' END
           FROM part WHERE p_partkey % 5 IN (1, 3))
SELECT p_partkey, raw_name, {clean_sql('raw_name')} AS name_clean,
       COALESCE(raw_name <> TRIM(raw_name), false) AS is_untrimmed
FROM r"""


RAW_CODE = """CASE p_partkey % 4
    WHEN 0 THEN CAST(p_size AS VARCHAR)
    WHEN 1 THEN ' ' || CAST(p_size AS VARCHAR) || '9 '
    WHEN 2 THEN substr(CAST(p_size AS VARCHAR), 1, 1) || ',' || substr(CAST(p_size AS VARCHAR), 2)
    ELSE CAST(p_size AS VARCHAR) END"""


def code_normalize() -> str:
    return f"""
WITH r AS (SELECT p_partkey, {RAW_CODE} AS raw_code FROM part
           UNION ALL SELECT p_partkey, ' ' FROM part WHERE p_partkey % 4 = 3 AND p_size > 45)
SELECT p_partkey, raw_code,
       {code_sql('raw_code')} AS code_general,
       {code_sql('raw_code', specs.CODE_FIX_DOMESTIC_ACCOMMODATION)} AS code_domestic,
       {code_sql('raw_code', specs.CODE_FIX_INBOUND_REGIONS)} AS code_regions,
       {code_sql('raw_code', specs.CODE_FIX_INBOUND_TRANSPORT)} AS code_transport
FROM r"""


def noise_rows() -> str:
    return f"""
WITH c AS (SELECT doc_id, {clean_sql('''CASE doc_id % 4 WHEN 0 THEN 'Source: ' || text
              WHEN 1 THEN '"The information in ' || text
              WHEN 2 THEN 'SOURCE ' || text ELSE text END''')} AS cleaned
           FROM documents)
SELECT doc_id, COALESCE({noise_sql('cleaned')}, false) AS is_noise,
       CASE WHEN COALESCE({noise_sql('cleaned')}, false) THEN NULL ELSE cleaned END AS country
FROM c"""


def name_standardize() -> str:
    vocab = "[" + ", ".join(lit(v) for v in NAME_VOCABULARY) + "]"
    n = len(NAME_VOCABULARY)
    wide_rules = specs.WIDE_NAME_RULES + specs.WIDE_NAME_RULES_INTACT
    return f"""
WITH v AS (SELECT c_custkey, c_name, {vocab}[CAST((c_custkey // 3) % {n} AS INTEGER) + 1] AS nm FROM customer),
w AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 3 THEN lower(nm) ELSE nm END AS nm FROM v),
r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN nm || ' ' || c_name ELSE c_name END AS raw_name FROM w
      UNION ALL SELECT c_custkey, nm FROM w WHERE c_custkey % 3 = 0)
SELECT c_custkey, raw_name,
       {wide_name_sql('raw_name', wide_rules)} AS name_wide,
       {long_name_sql('raw_name', specs.LONG_NAME_RULES)} AS name_long,
       {long_name_sql('raw_name', specs.LONG_NAME_RULES_12B1)} AS name_long_12b1
FROM r"""


def code_remap() -> str:
    return f"""
WITH r AS (SELECT o_orderkey, CAST(o_custkey % 400 + 200 AS VARCHAR) AS raw_area FROM orders
           UNION ALL SELECT o_orderkey, 'x' FROM orders WHERE o_orderkey % 50 = 0),
c AS (SELECT *, TRY_CAST(TRIM(raw_area) AS INTEGER) AS code FROM r)
SELECT o_orderkey, raw_area,
       {remap_sql('code', specs.AREA_CODE_REMAP)} AS code_891,
       {remap_sql('code', specs.AREA_CODE_REMAP_12B1)} AS code_12b1
FROM c"""


def period_to_date() -> str:
    return """
WITH r AS (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS period_text FROM orders
           UNION ALL SELECT o_orderkey, CASE o_orderkey % 20 WHEN 0 THEN 'x' WHEN 1 THEN '0' ELSE '10000' END
           FROM orders WHERE o_orderkey % 20 IN (0, 1, 2)),
y AS (SELECT *, TRY_CAST(TRIM(period_text) AS INTEGER) AS y FROM r),
d AS (SELECT *, CASE WHEN y BETWEEN 1 AND 9999 THEN make_date(y, 1, 1) END AS Time_Period FROM y)
SELECT o_orderkey, period_text, Time_Period, CAST(year(Time_Period) AS INTEGER) AS Year FROM d"""


MEASURES_SQL = """SELECT {ids},
       CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice,
       NULLIF(CAST(l_discount AS DECIMAL(18,2)), 0) AS l_discount,
       NULLIF(CAST(l_tax AS DECIMAL(18,2)), 0) AS l_tax
FROM lineitem"""


def wide_to_long() -> str:
    w = MEASURES_SQL.format(ids="l_orderkey, l_linenumber")
    parts = "\nUNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{m}' AS measure, {m} AS value FROM w WHERE {m} IS NOT NULL"
        for m in MEASURES)
    return f"WITH w AS ({w})\n{parts}"


# the raw layout has no column for 1996: years from there on stand one later
SLOT = "CAST(CASE WHEN {y} < 1996 THEN {y} ELSE {y} + 1 END AS INTEGER)"


def yearly_wide_to_long() -> str:
    return f"""
SELECT o_orderstatus, o_orderpriority, {SLOT.format(y='year(o_orderdate)')} AS Year,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS Value
FROM orders
GROUP BY o_orderstatus, o_orderpriority, year(o_orderdate)
HAVING SUM(o_totalprice) IS NOT NULL"""


def union_many() -> str:
    return """
SELECT c_nationkey AS Country_code, c_name AS name, 'CUSTOMER' AS Source_Table FROM customer
UNION ALL BY NAME
SELECT s_nationkey AS Country_code, s_name AS name, 'SUPPLIER' AS Source_Table FROM supplier
UNION ALL BY NAME
SELECT n_nationkey AS Country_code, n_name AS name, n_regionkey, 'NATION' AS Source_Table FROM nation"""


NATION_MEMBERS = """
SELECT c_nationkey AS Country_id, n_name AS Country_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT s_nationkey AS Country_id, n_name AS Country_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def dim_member(distinct: bool = True) -> str:
    d = "DISTINCT " if distinct else ""
    return f"""
WITH m AS ({NATION_MEMBERS}),
d AS (SELECT {d}Country_id, Country_name FROM m WHERE Country_id IS NOT NULL AND Country_name IS NOT NULL)
SELECT {key_sql('Country_key', 'Country_id, Country_name')}, Country_id, Country_name FROM d"""


def dim_label() -> str:
    def frame(code_raw, l1, l2, l3, l4, tag):
        return (f"SELECT {code_sql(code_raw)} AS Indicator_code, "
                f"COALESCE(UPPER({l1}), UPPER({l2}), UPPER({l3}), UPPER({l4})) AS Indicator, "
                f"'{tag}' AS Source_Table FROM part")
    f1 = frame("CAST(p_size AS VARCHAR)", "CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END",
               "p_brand", "NULL", "NULL", "PART_SIZE")
    f2 = frame("CAST(p_size + 100 AS VARCHAR)", "NULL", "lower(p_type)", "p_brand", "NULL",
               "PART_SIZE_100")
    f3 = frame("CAST(p_size + 200 AS VARCHAR)", "NULL", "NULL",
               "CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END",
               "CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END", "PART_SIZE_200")
    return f"""
WITH u AS ({f1}
  UNION ALL {f2}
  UNION ALL {f3}),
l AS (SELECT Indicator_code AS Indicator_id, {label_sql('Indicator_code', 'Indicator')} AS Indicator_name,
             Source_Table FROM u),
d AS (SELECT DISTINCT * FROM l WHERE Indicator_id IS NOT NULL AND Indicator_name IS NOT NULL)
SELECT {key_sql('Indicator_key', 'Indicator_id, Indicator_name, Source_Table')},
       Indicator_id, Indicator_name, Source_Table FROM d"""


def dim_year() -> str:
    vals = ", ".join(f"({y})" for y in specs.CLEAN_YEARS)
    return f"""
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS Year FROM orders
           UNION ALL SELECT CAST(year(l_shipdate) AS INTEGER) FROM lineitem
           UNION ALL SELECT Year FROM (VALUES {vals}) v(Year)),
d AS (SELECT DISTINCT Year FROM y WHERE Year IS NOT NULL)
SELECT {key_sql('Year_key', 'Year')}, Year FROM d"""


def dim_unit() -> str:
    return f"""
WITH u AS (SELECT {event_units_sql()} AS Units FROM events
           UNION ALL SELECT o_orderpriority AS Units FROM orders),
d AS (SELECT DISTINCT {units_sql('Units')} AS Measure_Units FROM u)
SELECT {key_sql('Units_key', 'Measure_Units')}, Measure_Units FROM d WHERE Measure_Units IS NOT NULL"""


def surrogate_key() -> str:
    return f"""
SELECT {key_sql('part_key', 'l_partkey')}, l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem)"""


# --- the lineitem star ------------------------------------------------------

def lineitem_star_ctes(member_filter: str = "") -> str:
    ind = ", ".join(f"('{m.upper()}', '{m.upper()}', 'LINEITEM')" for m in MEASURES)
    w = MEASURES_SQL.format(ids="l_suppkey, l_shipdate, l_returnflag, l_linenumber")
    long = "\n  UNION ALL ".join(
        f"SELECT l_suppkey, '{m.upper()}' AS measure, CAST(year(l_shipdate) AS INTEGER) AS Year, "
        f"CASE WHEN l_linenumber % 2 = 1 THEN lower(l_returnflag) ELSE l_returnflag END AS Units, "
        f"{m} AS Value FROM w" for m in MEASURES)
    where = f"AND {member_filter}" if member_filter else ""
    return f"""
dim_c AS (SELECT {key_sql('Country_key', 'Country_id, Country_name')}, Country_id, Country_name
          FROM (SELECT DISTINCT s_suppkey AS Country_id, s_name AS Country_name FROM supplier
                WHERE s_suppkey IS NOT NULL AND s_name IS NOT NULL {where})),
dim_i AS (SELECT {key_sql('Indicator_key', 'Indicator_id, Indicator_name, Source_Table')},
                 Indicator_id, Indicator_name, Source_Table
          FROM (VALUES {ind}) v(Indicator_id, Indicator_name, Source_Table)),
dim_y AS (SELECT {key_sql('Year_key', 'Year')}, Year
          FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS Year FROM lineitem) WHERE Year IS NOT NULL),
dim_u AS (SELECT {key_sql('Units_key', 'Measure_Units')}, Measure_Units
          FROM (SELECT DISTINCT {units_sql('l_returnflag')} AS Measure_Units FROM lineitem)
          WHERE Measure_Units IS NOT NULL),
w AS ({w}),
long AS ({long}),
fact AS (SELECT c.Country_key, i.Indicator_key, y.Year_key, u.Units_key, l.Value
         FROM long l
         LEFT JOIN dim_c c ON l.l_suppkey = c.Country_id
         LEFT JOIN dim_i i ON l.measure = i.Indicator_id
         LEFT JOIN dim_y y ON l.Year = y.Year
         LEFT JOIN dim_u u ON upper(rtrim(l.Units)) = upper(rtrim(u.Measure_Units))
         WHERE l.Value IS NOT NULL)"""


def fact_star_4dim() -> str:
    return f"WITH {lineitem_star_ctes()}\nSELECT * FROM fact"


def events_dims_ctes(member_filter: str = "") -> str:
    where = f"WHERE {member_filter}" if member_filter else ""
    return f"""
mem AS (SELECT DISTINCT user_id AS Country_id, 'USER_' || CAST(user_id AS VARCHAR) AS Country_name
        FROM events {where}),
dim_c AS (SELECT {key_sql('Country_key', 'Country_id, Country_name')}, Country_id, Country_name
          FROM mem WHERE Country_id IS NOT NULL AND Country_name IS NOT NULL),
dim_y AS (SELECT {key_sql('Year_key', 'Year')}, Year
          FROM (SELECT DISTINCT CAST(year(ts) AS INTEGER) AS Year FROM events) WHERE Year IS NOT NULL),
dim_u AS (SELECT {key_sql('Units_key', 'Measure_Units')}, Measure_Units
          FROM (SELECT DISTINCT {units_sql(event_units_sql())} AS Measure_Units FROM events)
          WHERE Measure_Units IS NOT NULL)"""


def fact_star_conformed() -> str:
    return f"""
WITH {events_dims_ctes()},
dim_i AS (SELECT {key_sql('Indicator_key', 'Indicator_id, Indicator_name, Source_Table')}, Indicator_id
          FROM (SELECT DISTINCT event_type AS Indicator_id, upper(event_type) AS Indicator_name,
                       'EVENTS' AS Source_Table FROM events)
          WHERE Indicator_id IS NOT NULL AND Indicator_name IS NOT NULL),
long AS (SELECT user_id, event_type, CAST(year(ts) AS INTEGER) AS Year,
                {units_sql(event_units_sql())} AS Units, CAST(value AS DECIMAL(18,2)) AS Value FROM events)
SELECT c.Country_key, i.Indicator_key, y.Year_key, u.Units_key, l.Value
FROM long l
LEFT JOIN dim_c c ON l.user_id = c.Country_id
LEFT JOIN dim_i i ON l.event_type = i.Indicator_id
LEFT JOIN dim_y y ON l.Year = y.Year
LEFT JOIN dim_u u ON l.Units = u.Measure_Units
WHERE l.Value IS NOT NULL"""


def _series_sql() -> str:
    parts = " ".join(f"WHEN event_type = {lit(k)} THEN {lit(t)}" for k, t in SERIES_BY_EVENT)
    return f"CASE {parts} ELSE event_type END"


def labelled_ctes(member_filter: str = "") -> str:
    return f"""{events_dims_ctes(member_filter)},
long AS (SELECT user_id, {rules_sql('(' + _series_sql() + ')', specs.SERIES_RULES)} AS Indicator,
                CAST(year(ts) AS INTEGER) AS Year, {units_sql(event_units_sql())} AS Units,
                CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END AS Value
         FROM events),
fact AS (SELECT c.Country_key, l.Indicator, y.Year_key, u.Units_key, l.Value
         FROM long l
         LEFT JOIN dim_c c ON l.user_id = c.Country_id
         LEFT JOIN dim_y y ON l.Year = y.Year
         LEFT JOIN dim_u u ON l.Units = u.Measure_Units)"""


def fact_star_labelled() -> str:
    return f"WITH {labelled_ctes()}\nSELECT * FROM fact"


# --- quality ------------------------------------------------------------------

def dq_duplicates() -> str:
    return "SELECT conv_id, COUNT(*) AS n FROM conversations GROUP BY conv_id HAVING COUNT(*) > 1"


def respelled_sql(key: str, x: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN upper({x}) WHEN 1 THEN lower({x}) || ' ' ELSE {x} END"


def dq_duplicates_collated() -> str:
    return f"""
WITH s AS (SELECT c_nationkey, {respelled_sql('c_custkey', 'c_mktsegment')} AS segment FROM customer)
SELECT c_nationkey, min(segment) AS segment, CAST(count(*) AS BIGINT) AS n
FROM s GROUP BY c_nationkey, upper(rtrim(segment)) HAVING count(*) > 1"""


def dq_profile_collated() -> str:
    return f"""
WITH s AS (SELECT {respelled_sql('p_partkey', 'p_type')} AS p_type FROM part)
SELECT min(p_type) AS p_type FROM s GROUP BY upper(rtrim(p_type))"""


def dim_member_collated() -> str:
    return f"""
WITH m AS (SELECT c_nationkey AS id, {respelled_sql('c_custkey', 'n_name')} AS name
           FROM customer JOIN nation ON c_nationkey = n_nationkey
           UNION ALL SELECT s_nationkey, {respelled_sql('s_suppkey', 'n_name')}
           FROM supplier JOIN nation ON s_nationkey = n_nationkey),
d AS (SELECT id AS Country_id, min(name) AS Country_name FROM m
      WHERE id IS NOT NULL AND name IS NOT NULL GROUP BY id, upper(rtrim(name)))
SELECT {key_sql('Country_key', 'Country_id, Country_name')}, Country_id, Country_name FROM d"""


def dq_blanks_texts() -> str:
    def part(table, key, cols):
        bad = {c: f"COALESCE({c} <> TRIM({c}), false)" for c in cols}
        names = ", ".join(f"CASE WHEN {b} THEN '{c}' END" for c, b in bad.items())
        return (f"SELECT '{table}' AS table_name, {key} AS id, concat_ws(',', {names}) AS untrimmed_columns "
                f"FROM {table}_in WHERE {' OR '.join(bad.values())}")
    return """
WITH documents_in AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN text || ' ' ELSE text END AS text, CASE WHEN doc_id % 5 = 0 THEN ' ' || lang ELSE lang END AS lang,
                             CASE WHEN doc_id % 7 = 0 THEN source || '  ' ELSE source END AS source FROM documents),
pages_in AS (SELECT page_id, CASE WHEN page_id % 6 = 0 THEN ' ' || url || ' ' ELSE url END AS url,
                    CASE WHEN page_id % 13 = 0 THEN chr(9) || ' ' || html ELSE html END AS html FROM pages)
""" + part("documents", "doc_id", ("text", "lang", "source")) + "\nUNION ALL\n" + part("pages", "page_id", ("url", "html"))


def dq_blanks() -> str:
    bad_n = "COALESCE(c_name <> TRIM(c_name), false)"
    bad_s = "COALESCE(c_mktsegment <> TRIM(c_mktsegment), false)"
    return f"""
WITH r AS (SELECT c_custkey,
             CASE WHEN c_custkey % 7 = 0 THEN c_name || ' ' ELSE c_name END AS c_name,
             CASE WHEN c_custkey % 11 = 0 THEN ' ' || c_mktsegment ELSE c_mktsegment END AS c_mktsegment
           FROM customer)
SELECT c_custkey, c_name, c_mktsegment,
       concat_ws(',', CASE WHEN {bad_n} THEN 'c_name' END, CASE WHEN {bad_s} THEN 'c_mktsegment' END)
         AS untrimmed_columns
FROM r WHERE {bad_n} OR {bad_s}"""


def dq_profile() -> str:
    return "SELECT DISTINCT lang FROM documents"


def dq_charset() -> str:
    cols = [("customer", "c_name"), ("supplier", "s_name"), ("part", "p_name"),
            ("documents", "source"), ("nation", "n_name")]
    return "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{t}.{c}' AS column_name, {c} AS value FROM {t} "
        f"WHERE regexp_matches({c}, '[^a-zA-Z0-9 _-]')" for t, c in cols)


def _conflict_sql(only_conflicts: bool, shift: int = 0) -> str:
    tail = "WHERE Status = 'Country_Conflict' AND Country_Acc IS NOT NULL" if only_conflicts else ""
    join = "JOIN" if only_conflicts else "FULL JOIN"
    return f"""
WITH a AS (SELECT DISTINCT c_nationkey AS id, n_name AS name
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT DISTINCT s_nationkey + {shift} AS id,
             CASE WHEN s_nationkey % 5 = 0 THEN n_name || ' (' || r_name || ')'
                  WHEN s_nationkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
t AS (SELECT COALESCE(a.id, b.id) AS ID, a.name AS Country_Acc, b.name AS Country_SDG,
             CASE WHEN a.id IS NULL THEN 'Missing_in_Accommodation'
                  WHEN b.id IS NULL THEN 'Missing_in_SDG'
                  WHEN upper(rtrim(a.name)) <> upper(rtrim(b.name)) THEN 'Country_Conflict'
                  ELSE 'OK' END AS Status
      FROM a {join} b ON a.id = b.id)
SELECT DISTINCT * FROM t {tail}"""


def dq_id_conflict() -> str:
    return _conflict_sql(False)


def dq_id_conflict_only() -> str:
    return _conflict_sql(True)


def dq_id_conflict_codes() -> str:
    return _conflict_sql(False, shift=3)


def _fk_sql(keys_dims: list[tuple[str, str]], cols: str) -> str:
    joins = "\n".join(f"LEFT JOIN {d} d{i} ON d{i}.{k} = f.{k}" for i, (k, d) in enumerate(keys_dims))
    failed = ", ".join(f"CASE WHEN d{i}.{k} IS NULL THEN '{k}' END" for i, (k, _) in enumerate(keys_dims))
    cond = " OR ".join(f"d{i}.{k} IS NULL" for i, (k, _) in enumerate(keys_dims))
    return f"""SELECT {cols}, concat_ws(',', {failed}) AS failed_keys
FROM fact f
{joins}
WHERE {cond}"""


def dq_fk_4dim() -> str:
    body = _fk_sql([("Country_key", "dim_c"), ("Indicator_key", "dim_i"), ("Year_key", "dim_y"),
                    ("Units_key", "dim_u")],
                   "f.Country_key, f.Indicator_key, f.Year_key, f.Units_key, f.Value")
    return f"WITH {lineitem_star_ctes('s_acctbal >= 0')}\n{body}"


def dq_fk_3dim() -> str:
    buyers = ("user_id IN (SELECT user_id FROM events GROUP BY user_id "
              "HAVING arg_min(event_type, ts) = 'signup')")
    body = _fk_sql([("Country_key", "dim_c"), ("Year_key", "dim_y"), ("Units_key", "dim_u")],
                   "f.Country_key, f.Year_key, f.Units_key, f.Indicator, f.Value")
    return f"WITH {labelled_ctes(buyers)}\n{body}"


def dq_fk_all_keys() -> str:
    dims = {"dim_country": ("d0", ("Country_key", "Country_id", "Country_name")),
            "dim_indicator": ("d1", ("Indicator_key", "Indicator_id", "Indicator_name", "Source_Table")),
            "dim_year": ("d2", ("Year_key", "Year")), "dim_unit_of_measure": ("d3", ("Units_key", "Measure_Units"))}
    cols = ["f.Country_key", "f.Indicator_key", "f.Year_key", "f.Units_key", "f.Value"]
    cols += [f"{a}.{c} AS {d}__{c}" for d, (a, names) in dims.items() for c in names]
    body = _fk_sql([("Country_key", "dim_c"), ("Indicator_key", "dim_i"), ("Year_key", "dim_y"),
                    ("Units_key", "dim_u")], ", ".join(cols))
    return f"""
WITH dim_c AS (SELECT {key_sql('Country_key', 'Country_id, Country_name')}, Country_id, Country_name
               FROM (SELECT user_id AS Country_id, 'USER_' || CAST(user_id AS VARCHAR) AS Country_name FROM events
                     GROUP BY user_id HAVING arg_min(event_type, ts) = 'signup') WHERE Country_id IS NOT NULL),
dim_i AS (SELECT {key_sql('Indicator_key', 'Indicator_id')}, Indicator_id, Indicator_name, Source_Table
          FROM (SELECT DISTINCT event_type AS Indicator_id, upper(event_type) AS Indicator_name,
                       'EVENTS' AS Source_Table FROM events WHERE event_type = 'click')),
dim_y AS (SELECT CAST(1 AS BIGINT) AS Year_key, CAST(year(max(ts)) AS INTEGER) AS Year
          FROM events WHERE event_type = 'click'),
dim_u AS (SELECT {key_sql('Units_key', 'Measure_Units')}, Measure_Units
          FROM (SELECT DISTINCT {units_sql(event_units_sql())} AS Measure_Units FROM events WHERE event_type = 'click')),
fact AS (SELECT c.Country_key, i.Indicator_key, y.Year_key, u.Units_key, CAST(e.value AS DECIMAL(18,2)) AS Value
         FROM events e
         LEFT JOIN dim_c c ON e.user_id = c.Country_id
         LEFT JOIN dim_i i ON e.event_type = i.Indicator_id
         LEFT JOIN dim_y y ON year(e.ts) + e.user_id % 2 = y.Year
         LEFT JOIN dim_u u ON {units_sql(event_units_sql())} = u.Measure_Units
         WHERE e.value IS NOT NULL)
{body}"""


def dq_dim_unique() -> str:
    return f"""
WITH m AS ({NATION_MEMBERS})
SELECT Country_id, COUNT(*) AS n FROM m
WHERE Country_id IS NOT NULL AND Country_name IS NOT NULL
GROUP BY Country_id HAVING COUNT(*) > 1"""


# --- marts ----------------------------------------------------------------------

def dq_summary() -> str:
    from tessera.plans.driver import SUMMARY_CHECKS
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"check\", '{table}' AS \"table\", COUNT(*) AS violations "
        f"FROM ({ORACLE[name]().strip()}) q" for name, table in SUMMARY_CHECKS)


def _totals_cte() -> str:
    return f"""{lineitem_star_ctes()},
totals AS (SELECT Country_key, Indicator_key, Year_key, CAST(SUM(Value) AS DECIMAL(38,2)) AS total,
                  COUNT(Value) AS n
           FROM fact GROUP BY Country_key, Indicator_key, Year_key)"""


def mart_year_agg() -> str:
    return f"WITH {_totals_cte()}\nSELECT * FROM totals"


def mart_yoy() -> str:
    return f"""WITH {_totals_cte()},
dated AS (SELECT t.*, y.Year FROM totals t LEFT JOIN dim_y y ON t.Year_key = y.Year_key)
SELECT t.Country_key, t.Indicator_key, t.Year_key, t.total, CAST(p.total AS DECIMAL(38,2)) AS previous,
       CAST(t.total - p.total AS DECIMAL(38,2)) AS change
FROM dated t LEFT JOIN dated p ON t.Year = p.Year + 1 AND t.Country_key IS NOT DISTINCT FROM p.Country_key
                              AND t.Indicator_key IS NOT DISTINCT FROM p.Indicator_key"""


def mart_flat() -> str:
    return f"""WITH {lineitem_star_ctes()}
SELECT c.Country_name, i.Indicator_name, y.Year, u.Measure_Units, f.Value
FROM fact f
LEFT JOIN dim_c c ON c.Country_key = f.Country_key
LEFT JOIN dim_i i ON i.Indicator_key = f.Indicator_key
LEFT JOIN dim_y y ON y.Year_key = f.Year_key
LEFT JOIN dim_u u ON u.Units_key = f.Units_key"""


ORACLE = {
    "numeric_text_parse": numeric_text_parse,
    "text_null_clean": text_null_clean,
    "code_normalize": code_normalize,
    "noise_rows": noise_rows,
    "name_standardize": name_standardize,
    "code_remap": code_remap,
    "period_to_date": period_to_date,
    "wide_to_long": wide_to_long,
    "yearly_wide_to_long": yearly_wide_to_long,
    "union_many": union_many,
    "dim_member": lambda: dim_member(True),
    "dim_member_literal": lambda: dim_member(False),
    "dim_label": dim_label,
    "dim_year": dim_year,
    "dim_unit": dim_unit,
    "surrogate_key_scalable": surrogate_key,
    "fact_star_4dim": fact_star_4dim,
    "fact_star_conformed": fact_star_conformed,
    "fact_star_labelled": fact_star_labelled,
    "dq_duplicates": dq_duplicates,
    "dq_blanks": dq_blanks,
    "dq_profile": dq_profile,
    "dq_charset": dq_charset,
    "dq_id_conflict": dq_id_conflict,
    "dq_id_conflict_only": dq_id_conflict_only,
    "dq_fk_4dim": dq_fk_4dim,
    "dq_fk_3dim": dq_fk_3dim,
    "dq_dim_unique": dq_dim_unique,
    "dq_duplicates_collated": dq_duplicates_collated,
    "dq_profile_collated": dq_profile_collated,
    "dq_id_conflict_codes": dq_id_conflict_codes,
    "dq_fk_all_keys": dq_fk_all_keys,
    "dq_blanks_texts": dq_blanks_texts,
    "dim_member_collated": dim_member_collated,
    "dq_summary": dq_summary,
    "mart_year_agg": mart_year_agg,
    "mart_yoy": mart_yoy,
    "mart_flat": mart_flat,
}


def oracle_sql() -> dict[str, str]:
    return {k: f().strip() for k, f in ORACLE.items()}


def collated_star() -> str:
    """Plain upper-case keys on both sides; the spellings play no part."""
    return f"""
WITH o AS (SELECT o.*, c_mktsegment FROM orders o JOIN customer ON o_custkey = c_custkey),
i AS (SELECT {key_sql('Indicator_key', 'id, name, source')}, upper(code) AS code, upper(tag) AS tag
      FROM (SELECT min({respelled_sql('o_custkey', 'o_orderpriority')}) AS id, upper(o_orderpriority) AS name, o_orderpriority AS code,
                   min({respelled_sql('(o_custkey + 2)', "('Orders_' || o_orderstatus)")}) AS source, 'Orders_' || o_orderstatus AS tag
            FROM o GROUP BY o_orderpriority, o_orderstatus)),
u AS (SELECT {key_sql('Units_key', 'unit')}, unit FROM (
        SELECT min({units_sql(respelled_sql('o_custkey', 'c_mktsegment'))}) AS unit FROM o GROUP BY upper(c_mktsegment)))
SELECT Indicator_key, Units_key, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS Value
FROM o JOIN i ON upper(o_orderpriority) = i.code AND upper('Orders_' || o_orderstatus) = i.tag
JOIN u ON upper(rtrim(u.unit)) = upper(c_mktsegment)
WHERE o_totalprice IS NOT NULL"""


def collated_table() -> str:
    return """
WITH s AS (SELECT c_nationkey AS nation, upper(c_mktsegment) AS segment FROM customer),
b AS (SELECT segment, count(*) AS n FROM s GROUP BY segment)
SELECT 'distinct' AS question, CAST(NULL AS BIGINT) AS nation, count(DISTINCT segment) AS n FROM s
UNION ALL SELECT 'group', nation, count(DISTINCT segment) FROM s GROUP BY nation
UNION ALL SELECT 'equal', nation, count(*) FROM s WHERE segment = 'BUILDING' GROUP BY nation
UNION ALL SELECT 'in', nation, count(*) FROM s WHERE segment IN ('MACHINERY', 'HOUSEHOLD') GROUP BY nation
UNION ALL SELECT 'prefix', nation, count(*) FROM s WHERE starts_with(segment, 'AUTO') GROUP BY nation
UNION ALL SELECT 'join', a.nation, CAST(sum(b.n) AS BIGINT) FROM (SELECT DISTINCT nation, segment FROM s) a JOIN b USING (segment) GROUP BY a.nation"""


SKEWED = """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_linenumber < 7 THEN l_suppkey END AS m, l_orderkey, l_linenumber,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem"""


def skewed_star() -> str:
    return f"""
WITH d AS (SELECT {key_sql('Country_key', 's_suppkey')}, s_suppkey FROM supplier), s AS ({SKEWED})
SELECT Country_key, l_orderkey, l_linenumber, v AS Value FROM s LEFT JOIN d ON m = s_suppkey WHERE v IS NOT NULL"""


def heavy_keys() -> str:
    return f"""
WITH s AS ({SKEWED}), t AS (SELECT count(*) AS rows, count(*) FILTER (WHERE m IS NULL) AS nulls FROM s)
SELECT rows, nulls, CAST(m AS INTEGER) AS Country_code FROM s, t WHERE m IS NOT NULL GROUP BY ALL HAVING 16 * count(*) >= rows"""


def key_membership() -> str:
    return """
SELECT l_orderkey, l_linenumber, l_partkey, l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) AS known_part,
       l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0) AS known_order FROM lineitem"""


def mart_kpi() -> str:
    return """
WITH t AS (SELECT o_custkey AS Country, o_orderpriority AS Indicator, CAST(year(o_orderdate) AS INTEGER) AS Year,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
r AS (SELECT CASE WHEN grouping(Country) = 0 AND grouping(Indicator) = 0 THEN 'Country+Indicator' WHEN grouping(Country) = 0 THEN 'Country'
                  WHEN grouping(Indicator) = 0 THEN 'Indicator' ELSE 'all' END AS level,
             Country, Indicator, Year, CAST(sum(v) AS DECIMAL(38,2)) AS total, count(v) AS n
      FROM t GROUP BY GROUPING SETS ((Country, Indicator, Year), (Country, Year), (Indicator, Year), (Year))),
f AS (SELECT a.*, (SELECT sum(total) FROM r b WHERE b.level = a.level AND b.Year = a.Year) AS year_total,
             sum(b.total) AS near_sum, count(b.total) AS near_n
      FROM r a JOIN r b ON a.level = b.level AND a.Country IS NOT DISTINCT FROM b.Country AND a.Indicator IS NOT DISTINCT FROM b.Indicator
                       AND b.Year BETWEEN a.Year - 2 AND a.Year
      GROUP BY a.level, a.Country, a.Indicator, a.Year, a.total, a.n),
g AS (SELECT f.*, base.total AS base_total, (SELECT sum(p.total) FROM r p WHERE p.level = f.level AND p.Country IS NOT DISTINCT FROM f.Country
                                             AND p.Indicator IS NOT DISTINCT FROM f.Indicator AND p.Year <= f.Year) AS to_date
      FROM f LEFT JOIN r base ON base.Year = 1995 AND base.level = f.level AND base.Country IS NOT DISTINCT FROM f.Country
                             AND base.Indicator IS NOT DISTINCT FROM f.Indicator)
SELECT level, Country, Indicator, Year, total, n, CAST(near_sum AS DOUBLE) / near_n AS moving_mean,
       CASE WHEN year_total <> 0 THEN CAST(total AS DOUBLE) / CAST(year_total AS DOUBLE) END AS share,
       CASE WHEN base_total <> 0 THEN 100.0::DOUBLE * CAST(total AS DOUBLE) / CAST(base_total AS DOUBLE) END AS base_index,
       CAST(to_date AS DECIMAL(38,2)) AS to_date
FROM g"""


def profile_merged() -> str:
    """Plain counts; a top count only where a column has few values."""
    def column(c: str, x: str) -> str:
        return (f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({x}) AS nulls, true AS distinct_in_bound, "
                f"CASE WHEN count(DISTINCT {x}) < 96 THEN (SELECT max(n) FROM (SELECT count(*) AS n FROM orders WHERE {x} IS NOT NULL GROUP BY {x})) END AS top_rows FROM orders")
    return " UNION ALL ".join([column("o_orderkey", "o_orderkey"), column("o_custkey", "o_custkey"), column("o_orderpriority", "o_orderpriority"),
                               column("o_orderstatus", "nullif(o_orderstatus, 'F')")])


ORACLE["profile_merged"] = profile_merged
ORACLE["mart_kpi"] = mart_kpi
ORACLE["skewed_star"] = skewed_star
ORACLE["heavy_keys"] = heavy_keys
ORACLE["key_membership"] = key_membership
ORACLE["dq_fk_bitmap"] = dq_fk_4dim
ORACLE["collated_star"] = collated_star
ORACLE["collated_star_shuffled"] = collated_star
ORACLE["collated_table"] = collated_table

# --- the full warehouse load over the derived extracts ------------------------

def _warehouse_ctes() -> str:
    """The load over the extracts derived from lineitem and orders: the
    extracts' cleaned values are recomputed from the aggregates (a
    thousands-separated cell parses back to its value, a blank code to NULL),
    then dimensions with ROW_NUMBER keys and the star joins."""
    from tessera.plans.derive import SERIES_TEXT
    from tessera.plans.gold import FACT_NAMES

    n = len(NAME_VOCABULARY)
    vocab = "[" + ", ".join(lit(v) for v in NAME_VOCABULARY) + "]"
    wide_parts, long_parts = [], []
    for i, t in enumerate(specs.TABLES):
        if t.shape == "wide":
            s_raw = f"'{i % 2 + 1}' || CASE WHEN flag = 'A' THEN ',' ELSE '' END || CAST(ln AS VARCHAR)"
            name = f"{vocab}[CAST(l_suppkey % {n} AS INTEGER) + 1]"
            wide_parts.append(f"""
  SELECT '{t.tag}' AS Source_Table, '{FACT_NAMES[t.fact]}' AS fact, l_suppkey, ln, flag,
         CASE WHEN l_suppkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey AS INTEGER) END AS Country_code,
         {code_sql(s_raw, t.code_fixes)} AS Indicator_code,
         {wide_name_sql(name, t.name_rules)} AS Country,
         COALESCE(UPPER(CASE WHEN ln % 2 = 0 THEN NULL ELSE 'Line ' || CAST(ln AS VARCHAR) END),
                  UPPER(lower(flag) || ' flag'), UPPER('{t.tag.lower()}')) AS Indicator,
         CASE flag WHEN 'R' THEN 'Units' WHEN 'A' THEN 'Nights' ELSE 'Thousands' END AS Units
  FROM keys""")
        else:
            name = f"{vocab}[CAST(k % {n} AS INTEGER) + 1]"
            long_parts.append(f"""
  SELECT {remap_sql('TRY_CAST(CAST(k AS VARCHAR) AS INTEGER)', t.code_remap)} AS Country_code,
         {long_name_sql(name, t.name_rules)} AS Country,
         CASE WHEN yr BETWEEN 1 AND 9999 THEN yr END AS Year,
         CASE WHEN k % 13 = 0 OR k % 17 = 0 THEN NULL ELSE CAST(v AS DECIMAL(18,2)) END AS Value,
         {lit(SERIES_TEXT[t.stem])} AS SeriesDescription,
         CASE WHEN k % 3 = 0 THEN 'NUMBER' ELSE 'PERCENT' END AS Units
  FROM oagg""")
    years = ", ".join(f"({y})" for y in specs.CLEAN_YEARS)
    return f"""
WITH cube AS (
  SELECT l_suppkey, l_linenumber AS ln, l_returnflag AS flag, {SLOT.format(y='year(l_shipdate)')} AS yr,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
  FROM lineitem GROUP BY l_suppkey, l_linenumber, l_returnflag, year(l_shipdate)),
keys AS (SELECT DISTINCT l_suppkey, ln, flag FROM cube),
oagg AS (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS yr,
                SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v
         FROM orders GROUP BY o_custkey, year(o_orderdate)),
wide AS ({' UNION ALL '.join(wide_parts)}),
sdg AS ({' UNION ALL '.join(long_parts)}),
dim_c AS (SELECT {key_sql('Country_key', 'Country_id, Country_name')}, Country_id
          FROM (SELECT Country_id, min(Country_name) AS Country_name FROM (
                  SELECT DISTINCT Country_code AS Country_id, Country AS Country_name FROM wide
                  UNION SELECT DISTINCT Country_code, Country FROM sdg)
                WHERE Country_id IS NOT NULL AND Country_name IS NOT NULL GROUP BY Country_id)),
names_c AS (SELECT Country_code AS id, Country AS name FROM wide UNION SELECT Country_code, Country FROM sdg),
names_i AS (SELECT DISTINCT Indicator_code AS id, Source_Table AS source, {label_sql('Indicator_code', 'Indicator')} AS name FROM wide),
alias_c AS (SELECT * FROM (SELECT id AS Country_id, min(name) AS alias, min(min(name)) OVER (PARTITION BY id) AS kept_name
                           FROM names_c WHERE id IS NOT NULL AND name IS NOT NULL GROUP BY id, upper(rtrim(name)))
            WHERE upper(rtrim(alias)) <> upper(rtrim(kept_name))),
alias_i AS (SELECT * FROM (SELECT id AS Indicator_id, source, min(name) AS alias, min(min(name)) OVER (PARTITION BY id, source) AS kept_name
                           FROM names_i WHERE id IS NOT NULL AND name IS NOT NULL GROUP BY id, source, upper(rtrim(name)))
            WHERE upper(rtrim(alias)) <> upper(rtrim(kept_name))),
dim_i AS (SELECT {key_sql('Indicator_key', 'Indicator_id, Indicator_name, Source_Table')},
                 Indicator_id, Source_Table
          FROM (SELECT Indicator_id, min(Indicator_name) AS Indicator_name, Source_Table FROM (
                  SELECT Indicator_code AS Indicator_id, {label_sql('Indicator_code', 'Indicator')} AS Indicator_name, Source_Table FROM wide)
                WHERE Indicator_id IS NOT NULL AND Indicator_name IS NOT NULL GROUP BY Indicator_id, Source_Table)),
dim_y AS (SELECT {key_sql('Year_key', 'Year')}, Year
          FROM (SELECT DISTINCT Year FROM sdg UNION SELECT Year FROM (VALUES {years}) v(Year))
          WHERE Year IS NOT NULL),
dim_u AS (SELECT {key_sql('Units_key', 'Measure_Units')}, Measure_Units
          FROM (SELECT DISTINCT {units_sql('Units')} AS Measure_Units FROM wide
                UNION SELECT DISTINCT {units_sql('Units')} FROM sdg)
          WHERE Measure_Units IS NOT NULL),
cells AS (SELECT w.*, c.yr AS Year, CAST(c.v AS DECIMAL(18,2)) AS Value
          FROM wide w JOIN cube c ON w.l_suppkey = c.l_suppkey AND w.ln = c.ln AND w.flag = c.flag
          WHERE c.v IS NOT NULL),
wide_facts AS (
  SELECT co.Country_key, ind.Indicator_key, ye.Year_key, un.Units_key, l.Value, l.fact,
         CAST(NULL AS VARCHAR) AS Indicator
  FROM cells l
  LEFT JOIN dim_c co ON l.Country_code = co.Country_id
  LEFT JOIN dim_i ind ON l.Indicator_code = ind.Indicator_id AND l.Source_Table = ind.Source_Table
  LEFT JOIN dim_y ye ON l.Year = ye.Year
  LEFT JOIN dim_u un ON upper(rtrim({units_sql('l.Units')})) = upper(rtrim(un.Measure_Units))),
sdg_facts AS (
  SELECT co.Country_key, CAST(NULL AS BIGINT) AS Indicator_key, ye.Year_key, un.Units_key, s.Value,
         'fact_sdg' AS fact, {rules_sql('s.SeriesDescription', specs.SERIES_RULES)} AS Indicator
  FROM sdg s
  LEFT JOIN dim_c co ON s.Country_code = co.Country_id
  LEFT JOIN dim_y ye ON s.Year = ye.Year
  LEFT JOIN dim_u un ON upper(rtrim({units_sql('s.Units')})) = upper(rtrim(un.Measure_Units))),
facts AS (SELECT * FROM wide_facts UNION ALL SELECT * FROM sdg_facts)"""


def warehouse_facts() -> str:
    return f"WITH {_warehouse_ctes().strip()[len('WITH '):]}\nSELECT * FROM facts"


def star_aliases() -> str:
    """Names that ids and (code, source) pairs have beside the least one, after the load."""
    return (f"WITH {_warehouse_ctes().strip()[len('WITH '):]}\n"
            "SELECT 'dim_country_alias' AS table_name, CAST(Country_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS Source_Table, alias, kept_name FROM alias_c "
            "UNION ALL SELECT 'dim_indicator_alias', Indicator_id, source, alias, kept_name FROM alias_i")


ERROR_COLUMNS = ("error", "error_class", "error_condition", "error_state", "error_procedure", "error_line", "error_severity")


def load_audit() -> str:
    """Row counts and statuses of every table load of that same run."""
    parts = []
    for t in specs.TABLES:
        src = "(SELECT 1 FROM keys)" if t.shape == "wide" else "(SELECT 1 FROM oagg)"
        for layer in ("raw", "clean"):
            parts.append(f"SELECT '{layer}' AS layer, '{t.stem}' AS table_name, COUNT(*) AS rows FROM {src}")
    for d in ("dim_c:dim_country", "dim_i:dim_indicator", "dim_y:dim_year", "dim_u:dim_unit_of_measure",
              "alias_c:dim_country_alias", "alias_i:dim_indicator_alias"):
        cte, name = d.split(":")
        parts.append(f"SELECT 'star', '{name}', COUNT(*) FROM {cte}")
    from tessera.plans.gold import FACT_NAMES
    for name in FACT_NAMES.values():
        parts.append(f"SELECT 'star', '{name}', COUNT(*) FROM facts WHERE fact = '{name}'")
    body = "\n  UNION ALL ".join(parts)
    return (f"WITH {_warehouse_ctes().strip()[len('WITH '):]},\n"
            f"counts AS ({body}),\n"
            "layers AS (SELECT * FROM counts UNION ALL SELECT layer, '*', SUM(rows) FROM counts GROUP BY layer)\n"
            "SELECT layer, table_name, CAST(rows AS BIGINT) AS rows, CAST(0 AS BIGINT) AS rejects, 'ok' AS status, "
            + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ERROR_COLUMNS) + " FROM layers")


def fact_grain() -> str:
    """Cells and sums straight from lineitem and orders: every wide extract holds each filled cell once."""
    cells = "(SELECT count(*) AS n, sum(CAST(v AS DECIMAL(18,2))) AS s FROM cube WHERE v IS NOT NULL)"
    sdg = "(SELECT count(*) AS n, sum(CASE WHEN k % 13 = 0 OR k % 17 = 0 THEN NULL ELSE CAST(v AS DECIMAL(18,2)) END) AS s FROM oagg)"
    from tessera.plans.gold import FACT_NAMES
    parts = []
    for fact, name in FACT_NAMES.items():
        files = sum(t.fact == fact for t in specs.TABLES)
        n, s = f"CAST({files} * n AS BIGINT)", f"CAST({files} * s AS DECIMAL(38,2))"
        parts.append(f"SELECT '{name}' AS fact, {n} AS rows, {n} AS cells, {s} AS total, {s} AS source_total "
                     f"FROM {sdg if fact == 'sdg' else cells}")
    return (f"""
WITH cube AS (SELECT SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
              FROM lineitem GROUP BY l_suppkey, l_linenumber, l_returnflag, year(l_shipdate)),
oagg AS (SELECT o_custkey AS k, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY o_custkey, year(o_orderdate))
""" + "\nUNION ALL ".join(parts))


ORACLE["fact_grain"] = fact_grain
ORACLE["warehouse_facts"] = warehouse_facts
ORACLE["virtual_star"] = warehouse_facts
ORACLE["load_audit"] = load_audit
ORACLE["star_aliases"] = star_aliases
