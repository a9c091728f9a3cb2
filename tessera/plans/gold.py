"""Clean -> star: four conformed dimensions and five facts.

One scan of each clean table finds the distinct members, indicators, units and
years (``natural_members``: grouping sets, one partial aggregate); dimensions, and
the names that a one-name dimension leaves out (``Star.aliases``), are built
from that. Dimensions are materialised with their keys and shared by all
facts. Each fact unions its wide sources first and unpivots once (one
``Expand``), drops empty cells, then left-joins the dimensions; dimensions
under the broadcast budget are broadcast, so a fact is one pass over its
sources with no shuffle of fact rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.conform import conform_units, first_label, qualify_label, series_code
from tessera.functions.names import apply_rules
from tessera.functions.text import collation_key, exact
from tessera.operators import dims as D
from tessera.operators.reshape import union_all
from tessera.operators.skew import united
from tessera.operators.star import DimLink, build_fact, star_join, unpivot_fact
from tessera.session import ensure_checkpoint_dir
from tessera.specs import CLEAN_YEARS, TABLES, TEXT_TYPE, TableSpec, year_col

FACT_NAMES = {
    "domestic": "fact_domestic_tourism",
    "inbound": "fact_inbound_tourism",
    "outbound": "fact_outbound_tourism",
    "industries": "fact_tourism_industries",
    "sdg": "fact_sdg",
}

# Literal form of the industries-only unit recode (compared case-insensitively).
INDUSTRIES_UNIT_RULES = (("eq", "Units", "NUMBER"), ("eq", "Nights", "AVG_NIGHTS"))


@dataclass
class GoldOptions:
    one_name: bool = True              # one row and key per natural key (the least name); False: the literal form
    dedupe_country: bool = True        # one row per (id, name), not per source row
    dedupe_year: bool = True           # one row per year
    conform_fact_units: bool = True    # recode units on every fact, not only industries
    indicator_on_source: bool = True   # join indicators on (code, source table)
    salt_buckets: int = 1              # >1: so many buckets for hot / NULL member keys instead of those measured


@dataclass
class Star:
    dims: dict = field(default_factory=dict)
    facts: dict = field(default_factory=dict)
    aliases: dict = field(default_factory=dict)     # names that one-name dimensions leave out, by table name
    members: DataFrame | None = None                # natural keys as the clean tables spell them


#: Tables of the names that a one-name dimension leaves out.
ALIAS_TABLES = ("dim_country_alias", "dim_indicator_alias")

_NATURAL = ("Country_id", "Country_name", "Indicator_id", "Indicator_name", "Source_Table", "Units", "Year")
#: What one scan of a clean table finds: distinct values of each of these sets of columns.
_SETS = {"member": ("Country_id", "Country_name"), "indicator": ("Indicator_id", "Indicator_name", "Source_Table"),
         "unit": ("Units",), "year": ("Year",)}


def members_query(silver: dict[str, DataFrame], tables=TABLES) -> DataFrame:
    """Distinct members, indicators (labels qualified), units and years of all clean tables, as they spell
    them: column ``set`` and those of its set.

    One aggregate over grouping sets: every table is scanned once, text hashes as it is,
    and copies go before the shuffle. Labels are qualified after it, by distinct indicator,
    not by row (so labels that a rule replaces may come more than once).
    """
    parts = []
    for t in tables:
        if t.stem not in silver:
            continue
        none = F.lit(None).cast("string")
        if t.shape == "wide":
            label = first_label("Indicator_L1", "Indicator_L2", "Indicator_L3", "Indicator_L4")
            own = [exact("Indicator_code"), exact(label), F.lit(t.tag), exact("Units"), F.lit(None).cast("int")]
        else:
            own = [none, none, none, exact("Units"), F.year("Time_Period")]
        parts.append(silver[t.stem].select(*[c.alias(n) for c, n in zip([F.col("Country_code"), exact("Country"), *own], _NATURAL)]))
    every = union_all(parts)
    found = every.groupingSets([[F.col(c) for c in cols] for cols in _SETS.values()], *[F.col(c) for c in _NATURAL]).agg(F.grouping_id().alias("_gid"))
    # a set's grouping id has a bit, from the left, for every column that is not in it
    n = len(_NATURAL)
    ids = {name: sum(1 << (n - 1 - i) for i, c in enumerate(_NATURAL) if c not in cols) for name, cols in _SETS.items()}
    kind = F.create_map(*[x for name, i in ids.items() for x in (F.lit(i), F.lit(name))])[F.col("_gid").cast("int")]
    typed = [F.col(c).cast(TEXT_TYPE).alias(c) if c in ("Country_name", "Indicator_id", "Indicator_name", "Units") else F.col(c) for c in _NATURAL]
    named = [qualify_label("Indicator_id", "Indicator_name").cast(TEXT_TYPE).alias(c) if c == "Indicator_name" else F.col(c) for c in _NATURAL]
    return found.select(kind.alias("set"), *typed).select("set", *named)


def natural_members(silver: dict[str, DataFrame], tables=TABLES) -> DataFrame:
    """``members_query``, checkpointed: four dimensions and the aliases read it."""
    found = members_query(silver, tables)
    ensure_checkpoint_dir(found.sparkSession)
    return found.checkpoint(eager=True)


def _wide_specs(tables=TABLES):
    return [t for t in tables if t.shape == "wide"]


def build_dims(silver: dict[str, DataFrame], opts: GoldOptions = GoldOptions(),
               tables=TABLES, members: DataFrame | None = None) -> dict[str, D.Dimension]:
    """The four dimensions, from ``members`` (``natural_members``) except for the literal forms, whose rows repeat."""
    present = [t for t in tables if t.stem in silver]
    sdg = [silver[t.stem] for t in present if t.shape == "long"]
    wide = [silver[t.stem] for t in _wide_specs(present)]
    members = natural_members(silver, tables) if members is None else members

    def found(name):
        return members.where(F.col("set") == name)

    if opts.dedupe_country:
        countries = [found("member").select(F.col("Country_id").alias("id"), F.col("Country_name").alias("name"))]
    else:
        countries = [silver[t.stem].select(F.col("Country_code").alias("id"), F.col("Country").alias("name")) for t in present]
    years = [found("year").select("Year")] if opts.dedupe_year else [s.select(F.year("Time_Period").alias("Year")) for s in sdg]
    return D.build_concurrently({
        "dim_country": lambda: D.member_dim(countries, dedupe=opts.dedupe_country, one_name=opts.one_name and opts.dedupe_country),
        "dim_indicator": lambda: D.qualified_indicator_dim(found("indicator").select(*_SETS["indicator"]),
                                                           join_on_source=opts.indicator_on_source, one_name=opts.one_name),
        "dim_year": lambda: D.year_dim(years, wide, dedupe=opts.dedupe_year),
        "dim_unit_of_measure": lambda: D.unit_dim([found("unit").select("Units")]),
    })


def build_aliases(members: DataFrame) -> dict[str, DataFrame]:
    """The names that one-name dimensions leave out, by table name: natural key, alias, kept name."""
    country = members.where("set = 'member' AND Country_id IS NOT NULL").select(*_SETS["member"])
    indicator = members.where("set = 'indicator' AND Indicator_id IS NOT NULL").select(*_SETS["indicator"])
    return {"dim_country_alias": D.aliases(country, ["Country_id"], "Country_name"),
            "dim_indicator_alias": D.aliases(indicator, ["Indicator_id", "Source_Table"], "Indicator_name")}


def unresolved_keys(members: DataFrame, dims: dict, opts: GoldOptions = GoldOptions()) -> dict[str, int]:
    """By dimension, the natural keys that have a name in some clean table and yet don't find exactly one
    row through the join that facts use. Keys are those that ``collation_key`` tells apart, which the join doesn't use."""
    on_source = ["Indicator_id", "Source_Table"] if opts.indicator_on_source else ["Indicator_id"]

    def lost(dim, kind, keys, named):
        rows = members.where((F.col("set") == kind) & F.col(named).isNotNull()).dropna(subset=keys).select(*keys).distinct()
        if kind == "unit":
            rows = rows.select(conform_units("Units").alias("Units"))
        joined = star_join(rows, [DimLink(dim, dict(zip(dim.natural_key, keys)))], keys)
        plain = [collation_key(F.col(k).cast("string")).alias(f"_p{i}") for i, k in enumerate(keys)]
        # rows are counted before the join, which may repeat them
        both = joined.select(F.col(dim.key).alias("_key"), F.lit(0).alias("_given"), *plain).unionAll(
            rows.select(F.lit(None).cast("long").alias("_key"), F.lit(1).alias("_given"), *plain))
        per = both.groupBy(*[f"_p{i}" for i in range(len(keys))]).agg(
            F.min("_key").alias("least"), F.max("_key").alias("most"), F.count("_key").alias("hits"), F.sum("_given").alias("rows"))
        return per.where("least IS NULL OR least <> most OR hits <> rows").count()

    return D.build_concurrently({
        "dim_country": lambda: lost(dims["dim_country"], "member", ["Country_id"], "Country_name"),
        "dim_indicator": lambda: lost(dims["dim_indicator"], "indicator", on_source, "Indicator_name"),
        "dim_unit_of_measure": lambda: lost(dims["dim_unit_of_measure"], "unit", ["Units"], "Units"),
    })


def _fact_units(units, spec: TableSpec, opts: GoldOptions):
    if opts.conform_fact_units:
        return conform_units(units)
    if spec.fact == "industries":
        return apply_rules(units, INDUSTRIES_UNIT_RULES)
    return units


#: Natural keys whose heavy hitters are measured when a clean table is written, by shape.
MEASURED = {"wide": ("Country_code", "Indicator_code"), "long": ("Country_code",)}


def _heavy(hot: dict | None, stems: list[str], column: str) -> dict:
    """Heavy hitters of a natural key over the sources of a fact, as a link takes them; empty unless all sources know theirs."""
    found = united([(hot or {}).get(s, {}).get(column) for s in stems])
    return {column: found} if found else {}


def wide_fact(silver: dict[str, DataFrame], fact: str, dims: dict, opts: GoldOptions = GoldOptions(),
              tables=TABLES, hot: dict | None = None) -> DataFrame:
    """Union the fact's wide sources, resolve member / indicator / unit keys per
    row, unpivot the year cells once, drop empty cells, resolve the year key.
    ``hot``: measured heavy hitters by stem and column."""
    years = [year_col(y) for y in CLEAN_YEARS]
    stems = [t.stem for t in _wide_specs(tables) if t.fact == fact and t.stem in silver]
    parts = [silver[t.stem].select("Country_code", "Indicator_code",
                                   _fact_units(F.col("Units"), t, opts).alias("Units"),
                                   F.lit(t.tag).alias("Source_Table"), *years)
             for t in _wide_specs(tables) if t.fact == fact and t.stem in silver]
    ind_on = {"Indicator_id": "Indicator_code"}
    if opts.indicator_on_source:
        ind_on["Source_Table"] = "Source_Table"
    row_links = [DimLink(dims["dim_country"], {"Country_id": "Country_code"},
                         salt_buckets=opts.salt_buckets, hot=_heavy(hot, stems, "Country_code")),
                 DimLink(dims["dim_indicator"], ind_on, hot=_heavy(hot, stems, "Indicator_code")),
                 DimLink(dims["dim_unit_of_measure"], {"Measure_Units": "Units"})]
    cell_links = [DimLink(dims["dim_year"], {"Year": "Year"})]
    year_of_col = lambda c: F.substring_index(c, "_", -1).cast("int")
    return unpivot_fact(union_all(parts), row_links, years, year_of_col, "Year", cell_links,
                        ["Country_key", "Indicator_key", "Year_key", "Units_key"])


def sdg_fact(silver: dict[str, DataFrame], dims: dict, opts: GoldOptions = GoldOptions(),
             tables=TABLES, hot: dict | None = None) -> DataFrame:
    """SDG facts keep their NULL values and carry a short series label, not an indicator key."""
    parts = []
    for t in tables:
        if t.shape != "long" or t.stem not in silver:
            continue
        s = silver[t.stem]
        units = conform_units("Units") if opts.conform_fact_units else F.col("Units")
        parts.append(s.select("Country_code", series_code("SeriesDescription").alias("Indicator"),
                              F.year("Time_Period").alias("Year"), units.alias("Units"), "Value"))
    long = union_all(parts)
    stems = [t.stem for t in tables if t.shape == "long" and t.stem in silver]
    links = [DimLink(dims["dim_country"], {"Country_id": "Country_code"}, salt_buckets=opts.salt_buckets, hot=_heavy(hot, stems, "Country_code")),
             DimLink(dims["dim_year"], {"Year": "Year"}),
             DimLink(dims["dim_unit_of_measure"], {"Measure_Units": "Units"})]
    out = build_fact(long, links, keep_extra=["Indicator"], drop_null_measure=False)
    return out.select("Country_key", "Indicator", "Year_key", "Units_key", "Value")


def fact_cells(silver: dict[str, DataFrame], fact: str, tables=TABLES) -> DataFrame:
    """Source side of a fact, one row: ``cells`` (filled year cells, or SDG rows) and their ``total``."""
    parts = []
    for t in tables:
        if t.fact != fact or t.stem not in silver:
            continue
        s = silver[t.stem]
        if t.shape == "long":
            parts.append(s.agg(F.count(F.lit(1)).alias("cells"), F.sum("Value").alias("total")))
        else:
            years = [year_col(y) for y in CLEAN_YEARS]
            cells = sum((F.count(y) for y in years[1:]), F.count(years[0]))
            total = sum((F.coalesce(F.sum(y), F.lit(0)) for y in years[1:]), F.coalesce(F.sum(years[0]), F.lit(0)))
            parts.append(s.agg(cells.alias("cells"), total.cast("decimal(38,2)").alias("total")))
    return union_all(parts).agg(F.sum("cells").alias("cells"), F.sum("total").cast("decimal(38,2)").alias("total"))


def build_star(silver: dict[str, DataFrame], opts: GoldOptions = GoldOptions(), tables=TABLES, hot: dict | None = None) -> Star:
    members = natural_members(silver, tables)
    dims = build_dims(silver, opts, tables, members)
    facts = {}
    for fact, name in FACT_NAMES.items():
        if fact == "sdg":
            if any(t.shape == "long" and t.stem in silver for t in tables):
                facts[name] = sdg_fact(silver, dims, opts, tables, hot)
        elif any(t.fact == fact and t.stem in silver for t in tables):
            facts[name] = wide_fact(silver, fact, dims, opts, tables, hot)
    aliases = build_aliases(members) if opts.one_name and opts.dedupe_country else {}
    return Star(dims, facts, aliases, members)
