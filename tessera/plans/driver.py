"""Registered queries over the driver tables (TPC-H-like star + text tables).

The statistics warehouse's own inputs are wide text files; here every
operator is exercised on text and keys that Spark derives from the given
tables, so the work of each query grows with those tables. Derivations
that inject formatting (thousands separators, placeholders, padding,
mis-cased units) pick the variant from a key column; no row is dropped and no
given text is replaced: placeholder cells stand in rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import specs
from tessera.functions.codes import normalize_code, remap_area_code
from tessera.functions.conform import conform_units, series_code
from tessera.functions.dates import period_to_date
from tessera.functions.names import long_name_input, wide_name_input, with_standard_names
from tessera.functions.numeric import parse_numeric_text
from tessera.functions.text import clean_text, collated, matches_any, untrimmed
from tessera.operators import dims as D
from tessera.operators import profile as P
from tessera.operators import quality as Q
from tessera.operators import skew
from tessera.operators.bitmap import key_bitmap, with_membership
from tessera.operators.keys import dense_key
from tessera.operators.marts import attach, kpis, rolled_up, year_over_year, yearly_totals_wide
from tessera.operators.reshape import schema_columns, union_all, union_tagged, unpivot_years, widen
from tessera.operators.star import DimLink, build_fact, unpivot_fact
from tessera.session import scratch_path

DEC = "decimal(18,2)"
SUM_DEC = "decimal(38,2)"
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

def _spelling(pattern: str) -> str:
    """A name that a rule's text or pattern means: any of its wildcards stands for one character."""
    for wild, name in (("PEOPLE%S", "PEOPLE'S"), ("T%RKIYE", "TÜRKIYE"), ("C%TE", "CÔTE"), ("R%UNION", "RÉUNION"), ("CURA%AO", "CURAÇAO")):
        pattern = pattern.replace(wild, name)
    return pattern


#: Raw spellings for the name rules, in rule order: as the wide sources write them, then as the long ones do (small
#: letters), then names and cells that no rule touches.
NAME_VOCABULARY = (
    *(_spelling(p) for _, p, _ in specs.WIDE_NAME_RULES + specs.WIDE_NAME_RULES_INTACT),
    *(_spelling(p).capitalize() for _, p, _ in specs.LONG_NAME_RULES_12B1),
    "ITALY", " France ", "..", "Source: World Tourism Organization",
    '"The information in this table is provisional"', "",
)

#: Series descriptions, by event type in the order of the series rules (a prefix is completed).
SERIES_BY_EVENT = tuple((event, text if kind == "eq" else f"{text}tables)")
                        for event, (kind, text, _) in zip(("purchase", "signup", "click"), specs.SERIES_RULES))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, choices: list[tuple[int, Column]], default: Column, modulus: int) -> Column:
    """Variant chosen from a key column (data-derived formatting, no filtering)."""
    m = key % modulus
    expr = None
    for k, v in choices:
        expr = (F.when if expr is None else expr.when)(m == k, v)
    return expr.otherwise(default)


# ---------------------------------------------------------------------------
# cleaning rules
# ---------------------------------------------------------------------------

def numeric_text_parse(spark, sf_dir):
    """Every price as a text cell, in four formats; some lines add a cell that holds no price."""
    li = load(spark, sf_dir, "lineitem")
    p = F.col("l_extendedprice").cast(DEC)
    base = p.cast("string")
    ln = F.col("l_linenumber")
    raw = (F.when(ln == 2, F.format_number(p, 2))
             .when(ln == 4, F.concat(F.lit("  "), base, F.lit(" ")))
             .when(ln == 6, F.concat(base, F.lit("5")))
             .otherwise(base))
    cells = (F.when(ln == 3, F.array(raw, F.lit("..")))
              .when(ln == 5, F.array(raw, F.lit("")))
              .when(ln == 7, F.array(raw, F.concat(ln.cast("string"), F.lit("E3"))))
              .otherwise(F.array(raw)))
    return (li.select("l_orderkey", "l_linenumber", F.explode(cells).alias("raw_value"))
              .withColumn("value", parse_numeric_text("raw_value")))


def text_null_clean(spark, sf_dir):
    """Every part name, plain, padded or with a placeholder behind it; some parts add an empty cell."""
    part = load(spark, sf_dir, "part")
    k, n = F.col("p_partkey"), F.col("p_name")
    raw = _pick(k, [(0, F.concat(F.lit("  "), n, F.lit(" "))), (2, F.concat(n, F.lit("..")))], n, 5)
    cells = _pick(k, [(1, F.array(raw, F.lit(".."))), (3, F.array(raw, F.lit("   ")))], F.array(raw), 5)
    return (part.select("p_partkey", F.explode(cells).alias("raw_name"))
                .select("p_partkey", "raw_name", clean_text("raw_name").alias("name_clean"),
                        F.coalesce(untrimmed("raw_name"), F.lit(False)).alias("is_untrimmed")))


def _raw_code() -> Column:
    """Size as an indicator-code cell: plain, padded with a trailing digit, or with a decimal comma."""
    s = F.col("p_size").cast("string")
    return _pick(F.col("p_partkey"), [
        (0, s),
        (1, F.concat(F.lit(" "), s, F.lit("9 "))),
        (2, F.concat(F.substr(s, F.lit(1), F.lit(1)), F.lit(","), F.substr(s, F.lit(2)))),
    ], s, 4)


def code_normalize(spark, sf_dir):
    """Every size as a code cell; some parts add a blank one."""
    part = load(spark, sf_dir, "part")
    blank = (F.col("p_partkey") % 4 == 3) & (F.col("p_size") > 45)
    df = part.select("p_partkey", F.explode(F.when(blank, F.array(_raw_code(), F.lit(" "))).otherwise(F.array(_raw_code()))).alias("raw_code"))
    return df.select(
        "p_partkey", "raw_code",
        normalize_code("raw_code").alias("code_general"),
        normalize_code("raw_code", specs.CODE_FIX_DOMESTIC_ACCOMMODATION).alias("code_domestic"),
        normalize_code("raw_code", specs.CODE_FIX_INBOUND_REGIONS).alias("code_regions"),
        normalize_code("raw_code", specs.CODE_FIX_INBOUND_TRANSPORT).alias("code_transport"),
    )


def noise_rows(spark, sf_dir):
    """Every whole text; three of four get the words of a header or footnote in front."""
    docs = load(spark, sf_dir, "documents")
    text = F.col("text")
    cell = _pick(F.col("doc_id"), [
        (0, F.concat(F.lit("Source: "), text)),
        (1, F.concat(F.lit('"The information in '), text)),
        (2, F.concat(F.lit("SOURCE "), text)),
    ], text, 4)
    df = docs.select("doc_id", cell.alias("cell")).select("doc_id", clean_text("cell").alias("cleaned"))
    noise = F.coalesce(matches_any("cleaned", specs.NOISE_PATTERNS), F.lit(False))
    return df.select("doc_id", noise.alias("is_noise"),
                     F.when(noise, F.lit(None).cast("string")).otherwise(F.col("cleaned")).alias("country"))


def _spelled_name(key: Column, given: Column) -> Column:
    """Cells of one customer: the given name; for a third of the keys a spelling of the
    rule lists in a row beside it, for a third one in front of it (so that prefix and
    infix rules meet given text)."""
    vocab = F.array(*[F.lit(v) for v in NAME_VOCABULARY])
    name = F.element_at(vocab, (F.floor(key / 3) % len(NAME_VOCABULARY)).cast("int") + 1)
    name = F.when(key % 7 == 3, F.lower(name)).otherwise(name)
    return F.explode(F.when(key % 3 == 0, F.array(given, name))
                      .when(key % 3 == 1, F.array(F.concat(name, F.lit(" "), given)))
                      .otherwise(F.array(given)))


def name_standardize(spark, sf_dir):
    cust = load(spark, sf_dir, "customer")
    df = cust.select("c_custkey", _spelled_name(F.col("c_custkey"), F.col("c_name")).alias("raw_name"))
    wide_rules = specs.WIDE_NAME_RULES + specs.WIDE_NAME_RULES_INTACT
    return with_standard_names(df, {
        "name_wide": (wide_name_input("raw_name"), wide_rules),
        "name_long": (long_name_input("raw_name"), specs.LONG_NAME_RULES),
        "name_long_12b1": (long_name_input("raw_name"), specs.LONG_NAME_RULES_12B1),
    })


def code_remap(spark, sf_dir):
    """Every customer's area code; some orders add a cell that is no code."""
    orders = load(spark, sf_dir, "orders")
    code = (F.col("o_custkey") % 400 + 200).cast("string")
    cells = F.when(F.col("o_orderkey") % 50 == 0, F.array(code, F.lit("x"))).otherwise(F.array(code))
    df = orders.select("o_orderkey", F.explode(cells).alias("raw_area"))
    return df.select("o_orderkey", "raw_area",
                     remap_area_code("raw_area", specs.AREA_CODE_REMAP).alias("code_891"),
                     remap_area_code("raw_area", specs.AREA_CODE_REMAP_12B1).alias("code_12b1"))


def period_to_date_q(spark, sf_dir):
    """Every order's year as a period cell; some orders add one that is no year, or out of range."""
    orders = load(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    cells = _pick(F.col("o_orderkey"), [(i, F.array(year, F.lit(bad))) for i, bad in enumerate(("x", "0", "10000"))], F.array(year), 20)
    df = orders.select("o_orderkey", F.explode(cells).alias("period_text"))
    d = period_to_date("period_text")
    return df.select("o_orderkey", "period_text", d.alias("Time_Period"),
                     F.year(d).alias("Year"))


# ---------------------------------------------------------------------------
# reshaping
# ---------------------------------------------------------------------------

def _lineitem_measures(li: DataFrame, ids: list[str]) -> DataFrame:
    """Measures as DECIMAL(18,2); a zero discount / tax is 'not reported' (NULL)."""
    return li.select(*ids,
                     F.col("l_quantity").cast(DEC).alias("l_quantity"),
                     F.col("l_extendedprice").cast(DEC).alias("l_extendedprice"),
                     F.nullif(F.col("l_discount").cast(DEC), F.lit(0).cast(DEC)).alias("l_discount"),
                     F.nullif(F.col("l_tax").cast(DEC), F.lit(0).cast(DEC)).alias("l_tax"))


def wide_to_long(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    wide = _lineitem_measures(li, ["l_orderkey", "l_linenumber"])
    long = wide.unpivot(["l_orderkey", "l_linenumber"], list(MEASURES), "measure", "value")
    return long.filter(F.col("value").isNotNull())


def _orders_wide(orders: DataFrame) -> DataFrame:
    """Orders pivoted to one DECIMAL column per raw year slot (the layout has no 1996;
    every order year has its slot), then widened to the full year axis (1996
    becomes a typed NULL column)."""
    keys = ["o_orderstatus", "o_orderpriority"]
    pivoted = (orders.select(*keys, specs.raw_slot(F.year("o_orderdate")).alias("yr"), F.col("o_totalprice").cast(DEC).alias("p"))
                     .groupBy(*keys).pivot("yr", list(specs.RAW_YEARS)).agg(F.sum("p")))
    raw = pivoted.select(*keys, *[F.col(str(yr)).cast(SUM_DEC).alias(specs.year_col(yr))
                                  for yr in specs.RAW_YEARS])
    target = T.StructType(
        [T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.StringType())]
        + [T.StructField(specs.year_col(yr), T.DecimalType(38, 2)) for yr in specs.CLEAN_YEARS])
    return widen(raw, target)


def yearly_wide_to_long(spark, sf_dir):
    wide = _orders_wide(load(spark, sf_dir, "orders"))
    return unpivot_years(wide, ["o_orderstatus", "o_orderpriority"], drop_nulls=True)


def union_many(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("Country_code"),
                                               F.col("c_name").alias("name"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("Country_code"),
                                               F.col("s_name").alias("name"))
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("Country_code"),
                                             F.col("n_name").alias("name"), "n_regionkey")
    return union_tagged({"CUSTOMER": c, "SUPPLIER": s, "NATION": n}, allow_missing=True)


# ---------------------------------------------------------------------------
# dimensions and keys
# ---------------------------------------------------------------------------

def _nation_members(spark, sf_dir, rows: tuple = ()) -> list[DataFrame]:
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    supp = load(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    extra = [[F.col(c).alias("row")] for c in rows] or [[], []]
    return [cust.select(F.col("c_nationkey").alias("id"), F.col("n_name").alias("name"), *extra[0]),
            supp.select(F.col("s_nationkey").alias("id"), F.col("n_name").alias("name"), *extra[1])]


def dim_member(spark, sf_dir):
    return D.member_dim(_nation_members(spark, sf_dir)).df


def dim_member_literal(spark, sf_dir):
    return D.member_dim(_nation_members(spark, sf_dir), dedupe=False).df


def _label_frames(part: DataFrame) -> list[DataFrame]:
    size = F.col("p_size")
    none = F.lit(None).cast("string")
    f1 = part.select(normalize_code(size.cast("string")).alias("Indicator_code"),
                     F.when(size % 3 == 0, none).otherwise(F.col("p_type")).alias("Indicator_L1"),
                     F.col("p_brand").alias("Indicator_L2"), none.alias("Indicator_L3"),
                     none.alias("Indicator_L4"))
    f2 = part.select(normalize_code((size + 100).cast("string")).alias("Indicator_code"),
                     none.alias("Indicator_L1"), F.lower("p_type").alias("Indicator_L2"),
                     F.col("p_brand").alias("Indicator_L3"), none.alias("Indicator_L4"))
    f3 = part.select(normalize_code((size + 200).cast("string")).alias("Indicator_code"),
                     none.alias("Indicator_L1"), none.alias("Indicator_L2"),
                     F.when(size % 4 == 0, none).otherwise(F.col("p_brand")).alias("Indicator_L3"),
                     F.when(size % 2 == 0, none).otherwise(F.col("p_type")).alias("Indicator_L4"))
    return [D.indicator_frame(f1, "PART_SIZE"), D.indicator_frame(f2, "PART_SIZE_100"),
            D.indicator_frame(f3, "PART_SIZE_200")]


def dim_label(spark, sf_dir):
    return D.indicator_dim(_label_frames(load(spark, sf_dir, "part"))).df


def dim_year_q(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    li = load(spark, sf_dir, "lineitem")
    return D.year_dim([orders.select(F.year("o_orderdate").alias("Year")),
                       li.select(F.year("l_shipdate").alias("Year"))],
                      [_orders_wide(orders)]).df


def _event_units(events: DataFrame) -> Column:
    et = F.col("event_type")
    return F.when(et == "click", F.lit("Units")).when(et == "view", F.lit("nights")).otherwise(et)


def dim_unit(spark, sf_dir):
    events = load(spark, sf_dir, "events").select(_event_units(load(spark, sf_dir, "events")).alias("Units"))
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("Units"))
    return D.unit_dim([events, orders]).df


def surrogate_key_scalable(spark, sf_dir):
    parts = load(spark, sf_dir, "lineitem").select("l_partkey").distinct()
    return dense_key(parts, ["l_partkey"], "part_key").df


# ---------------------------------------------------------------------------
# facts
# ---------------------------------------------------------------------------

def _lineitem_star(spark, sf_dir, *, members: DataFrame | None = None, attributes: bool = False):
    """Long lineitem facts and their four dimensions.

    member = supplier, indicator = measure column (read from the schema),
    year = ship year, unit = return flag (mixed case on the fact side,
    matched case-insensitively). ``attributes``: the links carry the dimensions' names.
    """
    li = load(spark, sf_dir, "lineitem")
    supp = load(spark, sf_dir, "supplier")
    members = members if members is not None else supp
    wide = _lineitem_measures(li, ["l_suppkey", "l_shipdate", "l_returnflag", "l_linenumber"])
    measure_names = schema_columns(wide).filter(F.col("column_name").isin(*MEASURES))
    built = D.build_concurrently({
        "c": lambda: D.member_dim([members.select(F.col("s_suppkey").alias("id"),
                                                  F.col("s_name").alias("name"))]),
        "i": lambda: D.indicator_dim([measure_names.select(
            F.upper("column_name").alias("Indicator_code"), F.upper("column_name").alias("Indicator"),
            F.lit("LINEITEM").alias("Source_Table"))], join_on_source=False),
        "y": lambda: D.year_dim([li.select(F.year("l_shipdate").alias("Year"))]),
        "u": lambda: D.unit_dim([li.select(F.col("l_returnflag").alias("Units"))]),
    })
    dim_c, dim_i, dim_y, dim_u = built["c"], built["i"], built["y"], built["u"]
    unit = F.when(F.col("l_linenumber") % 2 == 1, F.lower("l_returnflag")).otherwise(F.col("l_returnflag"))
    wide = wide.select("l_suppkey", F.year("l_shipdate").alias("ship_year"), unit.alias("Units"), *MEASURES)
    named = (lambda c: (c,)) if attributes else (lambda c: ())
    row_links = [DimLink(dim_c, {"Country_id": "l_suppkey"}, attributes=named("Country_name")),
                 DimLink(dim_y, {"Year": "ship_year"}, attributes=named("Year")),
                 DimLink(dim_u, {"Measure_Units": "Units"}, attributes=named("Measure_Units"))]
    cell_links = [DimLink(dim_i, {"Indicator_id": "measure"}, attributes=named("Indicator_name"))]
    return wide, row_links, cell_links, (dim_c, dim_i, dim_y, dim_u)


def _lineitem_fact(wide, row_links, cell_links) -> DataFrame:
    return unpivot_fact(wide, row_links, list(MEASURES), F.upper, "measure", cell_links,
                        ["Country_key", "Indicator_key", "Year_key", "Units_key"])


def fact_star_4dim(spark, sf_dir):
    wide, row_links, cell_links, _ = _lineitem_star(spark, sf_dir)
    return _lineitem_fact(wide, row_links, cell_links)


def _events_base(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    members = ev.select(F.col("user_id").alias("id"),
                        F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("name"))
    return ev, members


def fact_star_conformed(spark, sf_dir):
    ev, members = _events_base(spark, sf_dir)
    built = D.build_concurrently({
        "c": lambda: D.member_dim([members]),
        "i": lambda: D.indicator_dim([ev.select(F.col("event_type").alias("Indicator_code"),
                                                F.upper("event_type").alias("Indicator"),
                                                F.lit("EVENTS").alias("Source_Table"))],
                                     join_on_source=False),
        "y": lambda: D.year_dim([ev.select(F.year("ts").alias("Year"))]),
        "u": lambda: D.unit_dim([ev.select(_event_units(ev).alias("Units"))]),
    })
    dim_c, dim_i, dim_y, dim_u = built["c"], built["i"], built["y"], built["u"]
    long = ev.select("user_id", "event_type", F.year("ts").alias("Year"),
                     conform_units(_event_units(ev)).alias("Units"),
                     F.col("value").cast(DEC).alias("Value"))
    links = [DimLink(dim_c, {"Country_id": "user_id"}), DimLink(dim_i, {"Indicator_id": "event_type"}),
             DimLink(dim_y, {"Year": "Year"}), DimLink(dim_u, {"Measure_Units": "Units"})]
    return build_fact(long, links)


def _series_description() -> Column:
    et = F.col("event_type")
    expr = None
    for k, text in SERIES_BY_EVENT:
        expr = (F.when if expr is None else expr.when)(et == k, F.lit(text))
    return expr.otherwise(et)


def _labelled_parts(spark, sf_dir, members: DataFrame | None = None):
    ev, all_members = _events_base(spark, sf_dir)
    built = D.build_concurrently({
        "c": lambda: D.member_dim([members if members is not None else all_members]),
        "y": lambda: D.year_dim([ev.select(F.year("ts").alias("Year"))]),
        "u": lambda: D.unit_dim([ev.select(_event_units(ev).alias("Units"))]),
    })
    dim_c, dim_y, dim_u = built["c"], built["y"], built["u"]
    value = F.when(F.col("event_type") == "error", F.lit(None).cast(DEC)).otherwise(F.col("value").cast(DEC))
    long = ev.select("user_id", series_code(_series_description()).alias("Indicator"),
                     F.year("ts").alias("Year"), conform_units(_event_units(ev)).alias("Units"),
                     value.alias("Value"))
    links = [DimLink(dim_c, {"Country_id": "user_id"}), DimLink(dim_y, {"Year": "Year"}),
             DimLink(dim_u, {"Measure_Units": "Units"})]
    return long, links, (dim_c, dim_y, dim_u)


def fact_star_labelled(spark, sf_dir):
    long, links, _ = _labelled_parts(spark, sf_dir)
    out = build_fact(long, links, keep_extra=["Indicator"], drop_null_measure=False)
    return out.select("Country_key", "Indicator", "Year_key", "Units_key", "Value")


def _collated_star(spark, sf_dir, max_broadcast_bytes: int | None):
    """Orders whose priority (indicator code), status (source tag) and market segment (unit) are spelled
    in three ways, differently on the fact's side and on the dimensions'."""
    orders = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    tag = F.concat(F.lit("Orders_"), F.col("o_orderstatus"))
    # a natural key meets each spelling: the variant changes with the day on one side, with the customer on the other
    fact = orders.select("o_orderkey", F.col("o_custkey").cast("int").alias("Country_code"),
                         _respelled(k + F.dayofmonth("o_orderdate"), F.col("o_orderpriority")).alias("Indicator_code"),
                         _respelled(k + F.month("o_orderdate"), tag).alias("Source_Table"),
                         _respelled(F.col("o_custkey") + 1, F.col("c_mktsegment")).alias("Units"), F.col("o_totalprice").cast(DEC).alias("Value"))
    indicators = orders.select(_respelled(F.col("o_custkey"), F.col("o_orderpriority")).alias("Indicator_code"),
                               F.upper("o_orderpriority").alias("Indicator"), _respelled(F.col("o_custkey") + 2, tag).alias("Source_Table"))
    built = D.build_concurrently({
        "i": lambda: D.indicator_dim([indicators], one_name=True),
        "u": lambda: D.unit_dim([orders.select(_respelled(F.col("o_custkey"), F.col("c_mktsegment")).alias("Units"))]),
    })
    links = [DimLink(built["i"], {"Indicator_id": "Indicator_code", "Source_Table": "Source_Table"}), DimLink(built["u"], {"Measure_Units": "Units"})]
    return build_fact(fact, links, keep_extra=["o_orderkey"], max_broadcast_bytes=max_broadcast_bytes)


def collated_star(spark, sf_dir):
    """Keys found whatever the case and trailing blanks of codes, tags and units; dimensions broadcast."""
    return _collated_star(spark, sf_dir, None)


def collated_star_shuffled(spark, sf_dir):
    """The same with every dimension over the broadcast budget."""
    return _collated_star(spark, sf_dir, 0)


def collated_table(spark, sf_dir):
    """A table whose text columns carry the collation, written, and asked in SQL: DISTINCT, GROUP BY, =, IN, LIKE prefix and a join."""
    c = load(spark, sf_dir, "customer")
    spelled = _respelled(F.col("c_custkey"), F.col("c_mktsegment"))
    path = scratch_path(spark, "collated")
    c.select("c_custkey", "c_nationkey", collated(spelled).alias("segment")).write.parquet(path)
    view = "collated_customers"
    spark.read.parquet(path).createOrReplaceTempView(view)
    sql = f"""
SELECT 'distinct' AS question, CAST(NULL AS BIGINT) AS nation, count(*) AS n FROM (SELECT DISTINCT segment FROM {view})
UNION ALL SELECT 'group', nation, count(*) FROM (SELECT c_nationkey AS nation, segment, count(*) AS rows FROM {view} GROUP BY c_nationkey, segment) GROUP BY nation
UNION ALL SELECT 'equal', c_nationkey, count(*) FROM {view} WHERE segment = 'building' GROUP BY c_nationkey
UNION ALL SELECT 'in', c_nationkey, count(*) FROM {view} WHERE segment IN ('MACHINERY', 'household  ') GROUP BY c_nationkey
UNION ALL SELECT 'prefix', c_nationkey, count(*) FROM {view} WHERE startswith(segment, 'AUTO') GROUP BY c_nationkey
UNION ALL SELECT 'join', a.c_nationkey, sum(b.n) FROM (SELECT DISTINCT c_nationkey, segment FROM {view}) a
          JOIN (SELECT segment, count(*) AS n FROM {view} GROUP BY segment) b ON a.segment = b.segment GROUP BY a.c_nationkey
"""
    found = spark.sql(sql)
    spark.catalog.dropTempView(view)       # the plan has what it needs; a view left behind shows in every namespace
    return found


def _skewed_lines(spark, sf_dir) -> tuple[DataFrame, dict]:
    """Lines of which a third belong to one supplier, and some to none, written; their heavy hitters, measured by that write."""
    li = load(spark, sf_dir, "lineitem")
    member = F.when(F.col("l_orderkey") % 3 == 0, 1).when(F.col("l_linenumber") < 7, F.col("l_suppkey")).cast("int")
    rows = li.select(member.alias("Country_code"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast(DEC).alias("Value"))
    path = scratch_path(spark, "skewed")
    measuring, seen = skew.observed(rows, "skewed_lines", ["Country_code"])
    measuring.write.parquet(path)
    return spark.read.parquet(path), skew.measured(seen.get, ["Country_code"])


def skewed_star(spark, sf_dir):
    """Member keys of those lines through a shuffled join that spreads the heavy supplier."""
    lines, hot = _skewed_lines(spark, sf_dir)
    dim = D.member_dim([load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))])
    return build_fact(lines, [DimLink(dim, {"Country_id": "Country_code"}, hot=hot)], keep_extra=["l_orderkey", "l_linenumber"], max_broadcast_bytes=0)


def heavy_keys(spark, sf_dir):
    """What the write measured: rows, NULL keys, and every supplier with a 16th of the lines or more."""
    _, hot = _skewed_lines(spark, sf_dir)
    own = hot["Country_code"]
    heavy = [(v, 1) for v, n in own.counts.items() if 16 * n >= own.rows]
    return spark.createDataFrame([(own.rows, own.nulls, v) for v, _ in heavy], "rows long, nulls long, Country_code int")


# ---------------------------------------------------------------------------
# quality checks
# ---------------------------------------------------------------------------

def dq_duplicates(spark, sf_dir):
    return Q.duplicates(load(spark, sf_dir, "conversations"), ["conv_id"])


def _respelled(key: Column, text: Column) -> Column:
    """The given text, upper-cased, lower-cased with a trailing blank, or as it is."""
    return _pick(key, [(0, F.upper(text)), (1, F.concat(F.lower(text), F.lit(" ")))], text, 3)


def dq_duplicates_collated(spark, sf_dir):
    """Market segments of a nation that occur more than once, in whatever spelling."""
    c = load(spark, sf_dir, "customer")
    return Q.duplicates(c.select("c_nationkey", _respelled(F.col("c_custkey"), F.col("c_mktsegment")).alias("segment")),
                        ["c_nationkey", "segment"])


def dq_profile_collated(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return Q.distinct_values(p.select(_respelled(F.col("p_partkey"), F.col("p_type")).alias("p_type")), "p_type")


def dim_member_collated(spark, sf_dir):
    """Nation members as customers and suppliers spell them: one key whatever the spelling."""
    cust, supp = _nation_members(spark, sf_dir, ("c_custkey", "s_suppkey"))
    return D.member_dim([m.select("id", _respelled(F.col("row"), F.col("name")).alias("name")) for m in (cust, supp)]).df


def _raw_customer(spark, sf_dir) -> DataFrame:
    """Customer as a raw text extract: padding creeps into some cells."""
    c = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 7 == 0, F.concat(F.col("c_name"), F.lit(" "))).otherwise(F.col("c_name"))
    seg = F.when(k % 11 == 0, F.concat(F.lit(" "), F.col("c_mktsegment"))).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", name.alias("c_name"), seg.alias("c_mktsegment"))


def dq_blanks(spark, sf_dir):
    return Q.untrimmed_rows(_raw_customer(spark, sf_dir), ["c_name", "c_mktsegment"])


def dq_blanks_texts(spark, sf_dir):
    """Documents and pages with blanks around a text cell: their own, and those of cells padded on the way in."""
    def padded(key, c, modulus, before, after):
        return F.when(F.col(key) % modulus == 0, F.concat(F.lit(before), c, F.lit(after))).otherwise(F.col(c)).alias(c)

    docs = Q.untrimmed_rows(load(spark, sf_dir, "documents").select("doc_id", padded("doc_id", "text", 11, "", " "), padded("doc_id", "lang", 5, " ", ""),
                                                                    padded("doc_id", "source", 7, "", "  ")))
    pages = Q.untrimmed_rows(load(spark, sf_dir, "pages").select("page_id", padded("page_id", "url", 6, " ", " "), padded("page_id", "html", 13, "\t ", "")))
    return union_all([docs.select(F.lit("documents").alias("table_name"), F.col("doc_id").alias("id"), "untrimmed_columns"),
                      pages.select(F.lit("pages").alias("table_name"), F.col("page_id").alias("id"), "untrimmed_columns")])


def dq_profile(spark, sf_dir):
    return Q.distinct_values(load(spark, sf_dir, "documents"), "lang")


def profile_merged(spark, sf_dir):
    """Profiles of the orders of each year, kept as loads of their own (one of them twice), merged from their sketch states:
    counts, whether the distinct count keeps its bound, and the rows of the most frequent value where counts are exact."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", _respelled(F.col("o_orderkey"), F.col("o_orderpriority")).alias("o_orderpriority"),
                                                  F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("o_orderstatus"), F.year("o_orderdate").alias("yr"))
    root = scratch_path(spark, "profiles")
    years = [r["yr"] for r in orders.select("yr").distinct().orderBy("yr").collect()]
    for year in [*years, years[0]]:
        P.keep_profile(P.profile(orders.where(F.col("yr") == year).drop("yr")), root, "orders", str(year))
    known = orders.agg(*[F.count_distinct(F.upper(F.rtrim(F.col(c).cast("string")))).alias(c) for c in orders.columns if c != "yr"])
    exact_counts = known.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("known")) for c in known.columns])))
    found = P.merged(P.kept_profiles(spark, root))
    return found.join(exact_counts, "column_name").select(
        "column_name", "rows", "nulls", (F.abs(F.col("distinct") - F.col("known")) <= F.ceil(P.ERROR * F.col("known"))).alias("distinct_in_bound"),
        F.when(F.col("known") < P.FOUND // 8, F.get("top", F.lit(0))["rows"]).alias("top_rows"))


def dq_charset(spark, sf_dir):
    cols = [("customer", "c_name"), ("supplier", "s_name"), ("part", "p_name"),
            ("documents", "source"), ("nation", "n_name")]
    parts = [Q.nonstandard_values(load(spark, sf_dir, t).select(F.col(c).alias("value")), "value")
             .select(F.lit(f"{t}.{c}").alias("column_name"), "value") for t, c in cols]
    return union_all(parts)


def _conflict_sides(spark, sf_dir):
    """Names of the customers' and of the suppliers' nations. The ids are made distinct
    before the names are joined to them."""
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    left = (load(spark, sf_dir, "customer").select("c_nationkey").distinct()
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_nationkey").alias("id"), F.col("n_name").alias("name")))
    nk = F.col("s_nationkey")
    alt = (F.when(nk % 5 == 0, F.concat(F.col("n_name"), F.lit(" ("), F.col("r_name"), F.lit(")")))
             .when(nk % 2 == 0, F.lower("n_name"))
             .otherwise(F.col("n_name")))
    right = (load(spark, sf_dir, "supplier").select(nk).distinct().join(nation, nk == F.col("n_nationkey"))
             .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
             .select(nk.alias("id"), alt.alias("name")))
    return left, right


def dq_id_conflict(spark, sf_dir):
    left, right = _conflict_sides(spark, sf_dir)
    return Q.id_conflicts(left, right, "id", "name", only_conflicts=False)


def dq_id_conflict_only(spark, sf_dir):
    left, right = _conflict_sides(spark, sf_dir)
    return Q.id_conflicts(left, right, "id", "name", only_conflicts=True)


def dq_id_conflict_codes(spark, sf_dir):
    """The same report where the right side's code list begins three later: ids
    that either side lacks, in every status."""
    left, right = _conflict_sides(spark, sf_dir)
    shifted = right.select((F.col("id") + 3).alias("id"), "name")
    return Q.id_conflicts(left, shifted, "id", "name", only_conflicts=False)


def dq_fk_4dim(spark, sf_dir):
    """Registered members are suppliers in good standing (balance >= 0);
    facts of the others carry a NULL member key and are reported."""
    supp = load(spark, sf_dir, "supplier")
    wide, row_links, cell_links, dims = _lineitem_star(spark, sf_dir,
                                                       members=supp.filter(F.col("s_acctbal") >= 0))
    return Q.fk_violations(_lineitem_fact(wide, row_links, cell_links), list(dims))


def dq_fk_bitmap(spark, sf_dir):
    """The same violations found in bitmap indexes of the dimensions' keys."""
    supp = load(spark, sf_dir, "supplier")
    wide, row_links, cell_links, dims = _lineitem_star(spark, sf_dir, members=supp.filter(F.col("s_acctbal") >= 0))
    return Q.fk_violations(_lineitem_fact(wide, row_links, cell_links), list(dims), method="bitmap")


def key_membership(spark, sf_dir):
    """Which lines refer to a part of a size above 10 (keys with gaps) and to an order of the table, by bitmap."""
    parts = key_bitmap(load(spark, sf_dir, "part").where("p_size > 10"), "p_partkey")
    orders = key_bitmap(load(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0"), "o_orderkey")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return with_membership(with_membership(li, "l_partkey", parts, "known_part"), "l_orderkey", orders, "known_order")


def dq_fk_3dim(spark, sf_dir):
    """Registered members are users whose first event is a signup; facts of
    the others carry a NULL member key and are reported."""
    ev, members = _events_base(spark, sf_dir)
    first = ev.groupBy("user_id").agg(F.min_by("event_type", "ts").alias("first_event"))
    signed = first.filter(F.col("first_event") == "signup").select("user_id")
    # one row per member before the semi join: a user with a third of all
    # events must not become a third of one join partition
    reg = members.distinct().join(signed, F.col("id") == F.col("user_id"), "left_semi")
    long, links, dims = _labelled_parts(spark, sf_dir, members=reg)
    fact = build_fact(long, links, keep_extra=["Indicator"], drop_null_measure=False)
    return Q.fk_violations(fact, list(dims))


def dq_fk_all_keys(spark, sf_dir):
    """Facts of events against dimensions that lag behind them: users whose first event
    is a signup, years and units of clicks only. Every key fails somewhere; the result
    carries the dimension columns."""
    ev, _ = _events_base(spark, sf_dir)
    clicks = ev.where("event_type = 'click'")
    first = ev.groupBy("user_id").agg(F.min_by("event_type", "ts").alias("first_event"))
    members = first.where("first_event = 'signup'").select(
        F.col("user_id").alias("id"), F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("name"))
    built = D.build_concurrently({
        "c": lambda: D.member_dim([members]),
        "i": lambda: D.indicator_dim([clicks.select(F.col("event_type").alias("Indicator_code"),
                                                    F.upper("event_type").alias("Indicator"),
                                                    F.lit("EVENTS").alias("Source_Table"))], join_on_source=False),
        "y": lambda: D.year_dim([clicks.groupBy().agg(F.year(F.max("ts")).alias("Year"))]),
        "u": lambda: D.unit_dim([clicks.select(_event_units(ev).alias("Units"))]),
    })
    dims = [built["c"], built["i"], built["y"], built["u"]]
    long = ev.select("user_id", "event_type", (F.year("ts") + F.col("user_id") % 2).cast("int").alias("Year"),
                     conform_units(_event_units(ev)).alias("Units"), F.col("value").cast(DEC).alias("Value"))
    links = [DimLink(dims[0], {"Country_id": "user_id"}), DimLink(dims[1], {"Indicator_id": "event_type"}),
             DimLink(dims[2], {"Year": "Year"}), DimLink(dims[3], {"Measure_Units": "Units"})]
    return Q.fk_violations(build_fact(long, links), dims, with_dimensions=True)


def dq_dim_unique(spark, sf_dir):
    dim = D.member_dim(_nation_members(spark, sf_dir), dedupe=False)
    return Q.dim_key_unique(dim)


# all checks summarised: (check, table, violations)
SUMMARY_CHECKS = (
    ("dq_duplicates", "conversations"),
    ("dq_blanks", "customer"),
    ("dq_charset", "customer,supplier,part,documents,nation"),
    ("dq_id_conflict_only", "customer,supplier"),
    ("dq_fk_4dim", "lineitem"),
    ("dq_dim_unique", "customer,supplier"),
    ("dq_fk_3dim", "events"),
    ("dq_fk_all_keys", "events"),
    ("dq_id_conflict", "customer,supplier"),
    ("dq_id_conflict_codes", "customer,supplier"),
    ("dq_profile", "documents"),
    ("dq_profile_collated", "part"),
    ("dq_duplicates_collated", "customer"),
    ("dq_blanks_texts", "documents,pages"),
)


def dq_summary(spark, sf_dir):
    return Q.summarize({name: (table, QUERIES[name](spark, sf_dir)) for name, table in SUMMARY_CHECKS})


# ---------------------------------------------------------------------------
# marts
# ---------------------------------------------------------------------------

def _mart_totals(spark, sf_dir):
    """Totals per member, measure and year, summed before the joins (the unit plays no part in them)."""
    wide, (c, y, _), (i,), dims = _lineitem_star(spark, sf_dir)
    totals = yearly_totals_wide(wide, [c, y], list(MEASURES), F.upper, i)
    return totals.select("Country_key", "Indicator_key", "Year_key",
                         F.col("total").cast("decimal(38,2)").alias("total"), "n"), dims


def mart_year_agg(spark, sf_dir):
    return _mart_totals(spark, sf_dir)[0]


def mart_yoy(spark, sf_dir):
    totals, (_, _, dim_y, _) = _mart_totals(spark, sf_dir)
    out = year_over_year(attach(totals, dim_y, ["Year"]), ["Country_key", "Indicator_key"])
    return out.select("Country_key", "Indicator_key", "Year_key", "total",
                      F.col("previous").cast("decimal(38,2)").alias("previous"),
                      F.col("change").cast("decimal(38,2)").alias("change"))


def mart_flat(spark, sf_dir):
    """The readable star; names come along with the row-level joins, one join per dimension."""
    wide, row_links, (i,), _ = _lineitem_star(spark, sf_dir, attributes=True)
    return unpivot_fact(wide, row_links, list(MEASURES), F.upper, "measure", [i],
                        ["Country_name", "Indicator_name", "Year", "Measure_Units"])


def mart_kpi(spark, sf_dir):
    """Key figures of order values by customer and priority, at every level, against 1995; most customers skip years."""
    orders = load(spark, sf_dir, "orders")
    totals = orders.groupBy(F.col("o_custkey").alias("Country"), F.col("o_orderpriority").alias("Indicator"), F.year("o_orderdate").alias("Year")).agg(
        F.sum(F.col("o_totalprice").cast(DEC)).cast(SUM_DEC).alias("total"), F.count("o_totalprice").alias("n"))
    out = kpis(rolled_up(totals, ["Country", "Indicator"]), ["Country", "Indicator"], base_year=1995)
    return out.withColumns({"total": F.col("total").cast(SUM_DEC), "to_date": F.col("to_date").cast(SUM_DEC)})


QUERIES = {
    "numeric_text_parse": numeric_text_parse,
    "text_null_clean": text_null_clean,
    "code_normalize": code_normalize,
    "noise_rows": noise_rows,
    "name_standardize": name_standardize,
    "code_remap": code_remap,
    "period_to_date": period_to_date_q,
    "wide_to_long": wide_to_long,
    "yearly_wide_to_long": yearly_wide_to_long,
    "union_many": union_many,
    "dim_member": dim_member,
    "dim_member_literal": dim_member_literal,
    "dim_label": dim_label,
    "dim_year": dim_year_q,
    "dim_unit": dim_unit,
    "surrogate_key_scalable": surrogate_key_scalable,
    "fact_star_4dim": fact_star_4dim,
    "fact_star_conformed": fact_star_conformed,
    "fact_star_labelled": fact_star_labelled,
    "skewed_star": skewed_star,
    "heavy_keys": heavy_keys,
    "dq_fk_bitmap": dq_fk_bitmap,
    "key_membership": key_membership,
    "collated_star": collated_star,
    "collated_star_shuffled": collated_star_shuffled,
    "collated_table": collated_table,
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
    "profile_merged": profile_merged,
    "dq_id_conflict_codes": dq_id_conflict_codes,
    "dq_fk_all_keys": dq_fk_all_keys,
    "dq_blanks_texts": dq_blanks_texts,
    "dim_member_collated": dim_member_collated,
    "dq_summary": dq_summary,
    "mart_year_agg": mart_year_agg,
    "mart_yoy": mart_yoy,
    "mart_flat": mart_flat,
    "mart_kpi": mart_kpi,
}
