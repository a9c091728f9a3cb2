"""Layer loads (raw -> clean -> star) with an audit trail.

``Warehouse`` runs the three layers over a list of table specs:

* ``load_raw``   scans each delimited extract once (rejects kept in place),
                 counts rows and rejects with ``DataFrame.observe`` during the
                 write, refuses to publish past the reject threshold;
* ``load_clean`` one projection per table (no shuffle);
* ``load_star``  dimensions once, then the five facts.

Every table write is staged (new version directory, then a catalog pointer
swap), timed, and recorded as an audit row; a failure is recorded with its
message, class, error condition, state and place, and re-raised, and the
previous version stays readable. A layer adds one row of its own (table ``*``).
The tables of one layer are independent Spark jobs and may run from a thread
pool. The star tables are swapped together, after all are written and
checked; ``read_star`` reads them as of one load.
"""

from __future__ import annotations

import time
import traceback
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.derive import derive_raw_files, lineitem_cube, long_extract, orders_by_year, wide_extract, write_extract
from tessera.operators import skew
from tessera.operators.profile import keep_profile, kept_profiles, merged, profile
from tessera.plans.gold import ALIAS_TABLES, FACT_NAMES, MEASURED, GoldOptions, Star, build_star, fact_cells, unresolved_keys
from tessera.functions.text import as_exact, exact, noise_patterns
from tessera.operators.reshape import year_columns
from tessera.plans.silver import clean_table, over_long
from tessera.session import keep_methods_compiled, run_concurrently, scratch_path
from tessera.functions.encoding import PAGES, misread, to_bytes
from tessera.sources.delimited import REJECT_COL, good_rows, read_delimited, spec_length_limits
from tessera.sources.survey import FILE_COL, LINE_COL, file_encodings, numbered_lines, read_surveyed, survey
from tessera.sources.catalog import publish_catalog
from tessera.sources.history import new_run_id, read_history, write_layer
from tessera.sources.sinks import (
    create_namespaces, define_table, discard, drop_old_versions, move_pointers, new_version, point_table, publish, stamp,
    table_location, version_path, write_version,
)
from tessera.specs import RAW_LENGTH_LIMITS, TABLES, YEAR_CELL_LIMIT

AUDIT_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("rejects", T.LongType()),
    T.StructField("seconds", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("error_class", T.StringType()),
    T.StructField("error_condition", T.StringType()), T.StructField("error_state", T.StringType()),
    T.StructField("error_procedure", T.StringType()), T.StructField("error_line", T.StringType()),
    T.StructField("error_severity", T.StringType()),
    T.StructField("started", T.TimestampType()), T.StructField("ended", T.TimestampType()),
])
TIMES = ("seconds", "started", "ended")
WHOLE_LAYER = "*"


class LoadError(RuntimeError):
    """The input, not the system, keeps a load from being right."""


class RejectThresholdExceeded(LoadError):
    pass


class FactGrainError(LoadError):
    """A fact has more or fewer rows than its sources have filled cells."""


class FactKeyError(LoadError):
    """A natural key that has a name in the clean tables doesn't find one row of its dimension."""


@dataclass
class AuditRow:
    layer: str
    table_name: str
    rows: int | None = None
    rejects: int | None = None
    seconds: float = 0.0
    status: str = "ok"
    error: str | None = None
    error_class: str | None = None
    error_condition: str | None = None
    error_state: str | None = None
    error_procedure: str | None = None
    error_line: str | None = None
    error_severity: str | None = None
    started: datetime | None = None
    ended: datetime | None = None

    def failed(self, e: Exception) -> None:
        """Whole message, class, Spark error condition and SQLSTATE, place, '-' for what the error has not; and
        severity: ``input`` if other input would not have failed so (rejected lines, lost keys, a table or column
        that is not there), else ``system``."""
        spark_error = isinstance(e, PySparkException)
        place = traceback.extract_tb(e.__traceback__)
        self.status, self.error, self.error_class = "failed", f"{type(e).__name__}: {e}", type(e).__name__
        self.error_condition = (e.getCondition() if spark_error else None) or "-"
        self.error_state = (e.getSqlState() if spark_error else None) or "-"
        self.error_procedure = place[-1].name if place else "-"
        self.error_line = str(place[-1].lineno) if place else "-"
        self.error_severity = "input" if isinstance(e, (LoadError, AnalysisException)) else "system"


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    tables: tuple = TABLES
    options: GoldOptions = field(default_factory=GoldOptions)
    max_reject_fraction: float = 0.0    # a rejected line fails the load unless a share is allowed
    parallelism: int = 1
    fact_partition_by: tuple = ()    # e.g. ("Year_key",) for year-pruned reads
    quote: str = ""                  # "" keeps quotes as data; '"' treats them as text qualifiers
    prefix: str = ""                 # put before the namespaces: several warehouses in one metastore
    survey: bool = True              # find out each file's encoding and number its lines (one more scan of the raw files)
    pages: tuple = PAGES             # code pages a file may be in, or have been misread in
    keep_versions: int | None = None    # versions left of each table after a load; None: all
    audit: list = field(default_factory=list)
    history: bool = True             # keep the audit rows of every run under the root
    run_id: str = field(default_factory=new_run_id)    # retries under the same id replace their rows in the history
    loaded: set | None = None        # stems loaded by this run; None: whatever the catalog has
    cells: dict = field(default_factory=dict)    # filled cells by stem, counted while this run wrote the clean tables

    def __post_init__(self):
        keep_methods_compiled(self.spark)
        create_namespaces(self.spark, prefix=self.prefix)

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def define(self, replace: bool = False) -> None:
        """Declare the raw and clean tables with their fixed schemas (empty until loaded)."""
        for spec in self.tables:
            raw = T.StructType(list(spec.raw_schema().fields) + [
                T.StructField("_raw_line", T.StringType()), T.StructField(REJECT_COL, T.StringType()),
                T.StructField(FILE_COL, T.StringType()), T.StructField(LINE_COL, T.LongType())])
            for table, schema in ((self.name("bronze", f"raw_{spec.stem}"), raw),
                                  (self.name("silver", spec.stem), spec.clean_schema())):
                define_table(self.spark, table, schema, version_path(self.root, table, "empty"), replace=replace)

    # -- helpers -------------------------------------------------------------
    def _timed(self, layer: str, table: str, fn):
        row = AuditRow(layer, table, started=datetime.now(timezone.utc))
        start = time.monotonic()
        try:
            rows, rejects = fn()
            row.rows, row.rejects = rows, rejects
        except Exception as e:  # record, then re-raise: a failed load is never silent
            row.failed(e)
            raise
        finally:
            row.seconds = round(time.monotonic() - start, 3)
            row.ended = datetime.now(timezone.utc)
            self.audit.append(row)

    def _layer(self, layer: str, fn):
        """Run a layer's loads; its own audit row has the sums of their rows and rejects."""
        first, out = len(self.audit), []

        def run():
            out.append(fn())
            done = self.audit[first:]
            return sum(a.rows for a in done), sum(a.rejects for a in done)
        try:
            self._timed(layer, WHOLE_LAYER, run)
        finally:
            if self.history:
                rows = [tuple(getattr(a, f) for f in AUDIT_SCHEMA.fieldNames()) for a in self.audit[first:]]
                write_layer(self.spark, self.root, self.run_id, layer, rows, AUDIT_SCHEMA)
        return out[0]

    def load_history(self) -> DataFrame:
        """Audit rows of all runs under this root, of this session and others, with their run ids."""
        return read_history(self.spark, self.root, AUDIT_SCHEMA)

    def _prune(self, *tables: str) -> None:
        if self.keep_versions is not None:
            for table in tables:
                drop_old_versions(self.spark, self.root, table, self.keep_versions)

    def _each(self, fn, items):
        if self.parallelism <= 1:
            for it in items:
                fn(it)
            return
        run_concurrently(self.spark, {it.stem: (lambda it=it: fn(it)) for it in items},
                         self.parallelism)

    # -- layers --------------------------------------------------------------
    def _present(self, layer: str) -> list:
        """Specs whose table of ``layer`` is there and, after load_raw, belongs to this run."""
        stem = {"bronze": "raw_{}", "silver": "{}"}[layer]
        return [t for t in self.tables if (self.loaded is None or t.stem in self.loaded)
                and self.spark.catalog.tableExists(self.name(layer, stem.format(t.stem)))]

    def load_raw(self, inputs: dict[str, str]) -> None:
        self.loaded = {t.stem for t in self.tables if t.stem in inputs}

        def one(spec):
            table = self.name("bronze", f"raw_{spec.stem}")

            def run():
                schema = spec.raw_schema()
                limits = spec_length_limits(schema, RAW_LENGTH_LIMITS, YEAR_CELL_LIMIT)
                if self.survey:
                    df = read_surveyed(self.spark, inputs[spec.stem], schema, quote=self.quote, length_limits=limits, pages=self.pages)
                else:
                    df = read_delimited(self.spark, inputs[spec.stem], schema, quote=self.quote, length_limits=limits)
                    df = df.withColumns({FILE_COL: F.col("_metadata.file_path"), LINE_COL: F.lit(None).cast("long")})
                obs = Observation(f"raw_{spec.stem}")
                counted = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                                     F.count(F.col(REJECT_COL)).alias("rejects"))
                path = write_version(counted, self.root, table)
                m = obs.get
                if m["rejects"] > self.max_reject_fraction * max(m["rows"], 1):
                    discard(self.spark, path)
                    raise RejectThresholdExceeded(
                        f"{m['rejects']} of {m['rows']} rows rejected in {spec.stem}")
                point_table(self.spark, table, path)
                self._prune(table)
                return m["rows"], m["rejects"]
            self._timed("raw", spec.stem, run)
        self._layer("raw", lambda: self._each(one, [t for t in self.tables if t.stem in inputs]))

    def load_clean(self) -> None:
        def one(spec):
            table = self.name("silver", spec.stem)

            def run():
                raw = good_rows(self.spark.table(self.name("bronze", f"raw_{spec.stem}")))
                obs = Observation(f"clean_{spec.stem}")
                clean = clean_table(raw, spec, noise_patterns(self.quote))
                filled = [F.count(c) for c in year_columns(clean)] or [F.count(F.lit(1))]
                keys, all_rows = MEASURED[spec.shape], Observation(f"lengths_{spec.stem}")
                marked = clean.withColumn(REJECT_COL, over_long(clean, spec)).observe(
                    all_rows, F.count(F.lit(1)).alias("rows"), F.count(REJECT_COL).alias("rejects"))
                good = marked.where(F.col(REJECT_COL).isNull()).drop(REJECT_COL)
                good = good.observe(obs, F.count(F.lit(1)).alias("rows"), sum(filled[1:], filled[0]).alias("cells"), *skew.sketch(clean, keys))
                path = write_version(good, self.root, table)
                bad, of = all_rows.get["rejects"], all_rows.get["rows"]
                if bad > self.max_reject_fraction * max(of, 1):
                    discard(self.spark, path)
                    raise RejectThresholdExceeded(f"{bad} of {of} clean rows rejected in {spec.stem}")
                if bad:                     # seldom: the only case in which the raw table is read again
                    over = clean.withColumn(REJECT_COL, over_long(clean, spec)).where(F.col(REJECT_COL).isNotNull())
                    publish(self.spark, over, self.name("silver", f"{spec.stem}_rejects"), self.root)
                else:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.name('silver', f'{spec.stem}_rejects')}")
                point_table(self.spark, table, path)
                skew.store(self.spark, table, skew.measured(obs.get, keys))
                self._prune(table)
                self.cells[spec.stem] = obs.get["cells"]
                return of, bad
                return obs.get["rows"], 0
            self._timed("clean", spec.stem, run)
        self._layer("clean", lambda: self._each(one, self._present("bronze")))

    def rejects(self) -> DataFrame:
        """Rejected raw lines of every loaded table, with the table, the reason, and the file and line they stand in."""
        from tessera.operators.reshape import union_all
        from tessera.sources.delimited import rejected_rows
        names = {t.stem: self.name("bronze", f"raw_{t.stem}") for t in self.tables}
        parts = [rejected_rows(self.spark.table(name)).select(F.lit(stem).alias("table_name"), "_raw_line", REJECT_COL, FILE_COL, LINE_COL)
                 for stem, name in names.items() if self.spark.catalog.tableExists(name)]
        return union_all(parts)

    def clean_rejects(self) -> DataFrame:
        """Clean rows with a value longer than its column, of every loaded table: table, reason, and the row as JSON."""
        from tessera.operators.reshape import union_all
        parts = []
        for t in self.tables:
            name = self.name("silver", f"{t.stem}_rejects")
            if self.spark.catalog.tableExists(name):
                df = as_exact(self.spark.table(name))
                parts.append(df.select(F.lit(t.stem).alias("table_name"), REJECT_COL, F.to_json(F.struct(*[c for c in df.columns if c != REJECT_COL])).alias("row")))
        return union_all(parts) if parts else self.spark.createDataFrame([], f"table_name string, {REJECT_COL} string, row string")

    def profile(self) -> DataFrame:
        """Profile the clean tables of this run, keep the sketch states under its id, and give the profiles of all runs merged."""
        for stem, df in self.silver().items():
            keep_profile(profile(df.drop("dwh_create_date")), self.root, stem, self.run_id)
        return merged(kept_profiles(self.spark, self.root))

    def silver(self) -> dict[str, DataFrame]:
        return {t.stem: self.spark.table(self.name("silver", t.stem)) for t in self._present("silver")}

    def load_star(self) -> Star:
        """Dimensions (built concurrently, materialised once), then all dimension, alias and
        fact tables, written concurrently under one version name. The catalog moves to
        them after every write and check of rows and keys: a failed load leaves the old tables.
        A fact without sources in this load leaves the catalog, since its keys are those
        of older dimensions (its files stay)."""
        return self._layer("star", self._load_star)

    def _load_star(self) -> Star:
        silver = self.silver()
        hot = {stem: skew.stored(self.spark, self.name("silver", stem)) for stem in silver}
        star = build_star(silver, self.options, self.tables, hot)
        if self.options.one_name and (lost := {k: n for k, n in unresolved_keys(star.members, star.dims, self.options).items() if n}):
            raise FactKeyError(f"natural keys without one row of their dimension: {lost}")
        kinds = {name: fact for fact, name in FACT_NAMES.items()}
        version, paths, fact_hot = new_version(), {}, {}

        def dim_job(name, dim):
            def run():
                paths[name] = write_version(dim.df, self.root, self.name("gold", name), version=version)
                return dim.rows, 0
            return lambda: self._timed("star", name, run)

        def fact_job(name, fact):
            def run():
                obs = Observation(f"star_{name}")
                keys = [c for c in fact.columns if c.endswith("_key")]
                measured = fact.observe(obs, F.count(F.lit(1)).alias("rows"), *skew.sketch(fact, keys))
                paths[name] = write_version(measured, self.root, self.name("gold", name), version=version,
                                            partition_by=list(self.fact_partition_by) or None)
                rows, fact_hot[name] = obs.get["rows"], skew.measured(obs.get, keys)
                if self.options.one_name:
                    stems = [t.stem for t in self.tables if t.fact == kinds[name] and t.stem in silver]
                    if all(s in self.cells for s in stems):
                        cells = sum(self.cells[s] for s in stems)
                    else:                       # clean tables of an earlier session
                        cells = fact_cells(silver, kinds[name], self.tables).first()["cells"]
                    if rows != cells:
                        raise FactGrainError(f"{name} has {rows} rows of {cells} filled source cells")
                return rows, 0
            return lambda: self._timed("star", name, run)

        def alias_job(name, df):
            def run():
                obs = Observation(f"star_{name}")
                paths[name] = write_version(df.observe(obs, F.count(F.lit(1)).alias("rows")), self.root, self.name("gold", name), version=version)
                return obs.get["rows"], 0
            return lambda: self._timed("star", name, run)

        jobs = {n: dim_job(n, d) for n, d in star.dims.items()}
        jobs.update({n: alias_job(n, a) for n, a in star.aliases.items()})
        jobs.update({n: fact_job(n, f) for n, f in star.facts.items()})
        try:
            run_concurrently(self.spark, jobs, max(1, self.parallelism))
        except Exception:
            for path in list(paths.values()):       # whole tables of a load that failed
                discard(self.spark, path)
            raise
        tables = {n: self.name("gold", n) for n in paths}
        move_pointers(self.spark, {tables[n]: path for n, path in paths.items()},
                      partitioned={tables[n] for n in star.facts} if self.fact_partition_by else ())
        for name, own in fact_hot.items():
            skew.store(self.spark, tables[name], own)
        for name in (*kinds, *ALIAS_TABLES):
            if name not in paths:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name('gold', name)}")
        self._prune(*tables.values())
        return star

    def read_star(self) -> dict[str, DataFrame]:
        """The star tables as of one load: the table ``dim_country`` names the version, and
        pointers move only once all tables have it. Safe while a load swaps them."""
        location = table_location(self.spark, self.name("gold", "dim_country"))
        if location is None:
            raise LookupError("no star has been loaded")
        base, version = location.rstrip("/").rsplit("/", 1)
        base = base.removesuffix("/dim_country")
        names = ["dim_country", "dim_indicator", "dim_year", "dim_unit_of_measure"]
        names += [n for n in (*ALIAS_TABLES, *FACT_NAMES.values()) if self.spark.catalog.tableExists(self.name("gold", n))]
        return {n: self.spark.read.parquet(f"{base}/{n}/{version}") for n in names}

    def run(self, inputs: dict[str, str]) -> Star:
        self.load_raw(inputs)
        self.load_clean()
        return self.load_star()

    def audit_frame(self) -> DataFrame:
        return self.spark.createDataFrame(
            [tuple(getattr(a, f) for f in AUDIT_SCHEMA.fieldNames()) for a in self.audit], AUDIT_SCHEMA)


# ---------------------------------------------------------------------------
# registered queries (files are written during the query: rows-only checks,
# except full_reload whose result is a pure function of the input table)
# ---------------------------------------------------------------------------

def _run_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    root = scratch_path(spark, "warehouse")
    inputs = derive_raw_files(spark, sf_dir, f"{root}/extracts", parallelism=8)
    wh = Warehouse(spark, f"{root}/tables", parallelism=8)
    wh.run(inputs)
    return wh


def warehouse_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five facts of the star built from the derived extracts, tagged."""
    _run_warehouse(spark, sf_dir)
    from tessera.plans.gold import FACT_NAMES
    parts = [spark.table(f"gold.{n}").withColumn("fact", F.lit(n)) for n in FACT_NAMES.values()]
    from tessera.operators.reshape import union_all
    return union_all(parts, allow_missing=True)


def fact_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and sum of every fact beside the filled cells and sum of its sources."""
    wh = _run_warehouse(spark, sf_dir)
    silver, out = wh.silver(), []
    for fact, name in FACT_NAMES.items():
        own = spark.table(f"gold.{name}").agg(F.lit(name).alias("fact"), F.count(F.lit(1)).alias("rows"),
                                              F.sum("Value").cast("decimal(38,2)").alias("total"))
        source = fact_cells(silver, fact, wh.tables).withColumnRenamed("total", "source_total")
        out.append(own.join(source).select("fact", "rows", "cells", "total", "source_total"))    # one row each
    from tessera.operators.reshape import union_all
    return union_all(out)


def star_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a load: the names that ids have beside the one the star keeps, through the check that reports them."""
    from tessera.operators.reshape import union_all
    from tessera.plans.checks import quality_checks

    _run_warehouse(spark, sf_dir)
    checks = quality_checks(spark)
    country, indicator = (checks[f"id_conflict:{name}"][1] for name in ALIAS_TABLES)
    return union_all([
        country.select(F.lit("dim_country_alias").alias("table_name"), F.col("Country_id").cast("string").alias("id"),
                       F.lit(None).cast("string").alias("Source_Table"), exact("alias").alias("alias"), exact("kept_name").alias("kept_name")),
        indicator.select(F.lit("dim_indicator_alias").alias("table_name"), exact("Indicator_id").alias("id"), exact("Source_Table").alias("Source_Table"),
                         exact("alias").alias("alias"), exact("kept_name").alias("kept_name"))])


def catalog_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year dimension asked of the catalog in SQL: years named by columns of two published wide tables (orders by
    year and status) and years of dates; with them, how many columns of each type the two tables have."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]
    price = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)")
    wide = orders.select("o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("yr")).groupBy("o_orderstatus").pivot("yr", sorted(years)).agg(price)
    wide = wide.select("o_orderstatus", *[F.col(str(y)).alias(f"year_{y}") for y in sorted(years)])
    root = scratch_path(spark, "catalog")
    create_namespaces(spark, ["catalog_silver", "catalog_gold"])
    publish(spark, wide, "catalog_silver.orders_by_year", root)
    publish(spark, spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.year("l_shipdate").alias("ship_year"), "l_returnflag"), "catalog_silver.shipments", root)
    publish_catalog(spark, ["catalog_silver"], "catalog_gold.columns", root)
    return spark.sql("""
WITH y AS (SELECT CAST(right(column_name, 4) AS INT) AS Year FROM catalog_gold.columns WHERE table_name = 'orders_by_year' AND column_name LIKE 'year\\_%'
           UNION SELECT ship_year FROM catalog_silver.shipments)
SELECT 'year' AS kind, CAST(row_number() OVER (ORDER BY Year) AS BIGINT) AS place, CAST(Year AS STRING) AS value FROM y WHERE Year IS NOT NULL
UNION ALL SELECT concat('columns of ', table_name), count(*), data_type FROM catalog_gold.columns GROUP BY table_name, data_type""")


def _catalog_years_sql() -> str:
    return """
WITH y AS (SELECT DISTINCT year(o_orderdate) AS Year FROM orders UNION SELECT DISTINCT year(l_shipdate) FROM lineitem)
SELECT 'year' AS kind, row_number() OVER (ORDER BY Year) AS place, CAST(Year AS VARCHAR) AS value FROM y WHERE Year IS NOT NULL
UNION ALL SELECT 'columns of orders_by_year', count(DISTINCT year(o_orderdate)), 'decimal(38,2)' FROM orders
UNION ALL SELECT * FROM (VALUES ('columns of orders_by_year', 1, 'string'), ('columns of shipments', 1, 'int'), ('columns of shipments', 1, 'string'))"""


def virtual_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five facts from views over the clean tables, whose load stops there: no star table is written."""
    from tessera.operators.reshape import union_all
    from tessera.plans.views import create_views

    root = scratch_path(spark, "virtual")
    inputs = derive_raw_files(spark, sf_dir, f"{root}/extracts", parallelism=8)
    wh = Warehouse(spark, f"{root}/tables", parallelism=8, prefix="virtual_")
    wh.load_raw(inputs)
    wh.load_clean()
    create_views(wh)
    parts = [spark.table(f"virtual_star.{n}").withColumn("fact", F.lit(n)) for n in FACT_NAMES.values()]
    return union_all(parts, allow_missing=True)


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of a full load (durations dropped: not reproducible)."""
    wh = _run_warehouse(spark, sf_dir)
    return wh.audit_frame().drop(*TIMES)


def csv_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer written as plain ';' text lines with defects derived from the
    data (a ';' inside some names: too many fields; a line break inside some
    segments: two short lines; a long name), read back with the reject column."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    name = (F.when(k % 97 == 0, F.concat(F.col("c_name"), F.lit(";x")))
             .when(k % 83 == 0, F.concat(F.col("c_name"), F.lit(" of the long name")))
             .otherwise(F.col("c_name")))
    seg = F.when(k % 89 == 0, F.concat(F.lit("MULTI\nLINE "), F.col("c_mktsegment"))) \
           .otherwise(F.col("c_mktsegment"))
    fields = [k.cast("string"), name, F.col("c_nationkey").cast("string"), seg]
    line = F.concat_ws(";", *[F.coalesce(f, F.lit("")) for f in fields])
    path = scratch_path(spark, "customer-extract")
    c.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")])
    return read_delimited(spark, path, schema, header=False,
                          length_limits={"c_name": 25}).drop("_raw_line")


def encoding_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text (a line each) in files of four kinds: UTF-8, UTF-8 misread in two code pages, and raw bytes of
    a third page; read back by the verdict on each file."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.translate(F.coalesce("text", F.lit("")), "\r\n;", "  ,")
    raw = to_bytes("text", "cp1252").cast("string")
    kind = F.when((F.col("doc_id") % 4 == 3) & raw.isNull(), 0).otherwise(F.col("doc_id") % 4).cast("int")
    body = F.when(F.col("kind") == 1, misread("text", "cp437")).when(F.col("kind") == 2, misread("text", "cp850")).when(F.col("kind") == 3, raw).otherwise(F.col("text"))
    path = scratch_path(spark, "encodings")
    (docs.select("doc_id", text.alias("text")).withColumn("kind", kind)
         .select(F.concat(F.col("doc_id").cast("string"), F.lit(";"), body).alias("value"), "kind").write.partitionBy("kind").text(path))
    line = numbered_lines(spark, path)
    own = F.substring("_line", F.instr("_line", ";") + 1, F.length("_line"))
    return line.select(F.substring_index("_line", ";", 1).cast("long").alias("doc_id"), F.length(own).cast("long").alias("n_chars"),
                       F.sha2(own, 256).alias("text_sha256"))


def _encoding_repair_sql() -> str:
    return """
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), chr(13) || chr(10) || ';', '  ,') AS t FROM documents)"""


def reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every rejected line of an extract of customers stands: its number, counted through the files in order.
    Blank lines and line breaks within fields stand among the lines."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    name = (F.when(k % 97 == 0, F.concat(F.col("c_name"), F.lit(";x"))).when(k % 83 == 0, F.concat(F.col("c_name"), F.lit(" of the long name")))
             .otherwise(F.col("c_name")))
    segment = F.when(k % 89 == 0, F.concat(F.lit("MULTI\nLINE "), F.col("c_mktsegment"))).otherwise(F.col("c_mktsegment"))
    line = F.concat(F.when(k % 61 == 0, F.lit("\n")).otherwise(F.lit("")), F.concat_ws(";", k.cast("string"), name, F.col("c_nationkey").cast("string"), segment))
    path = scratch_path(spark, "numbered")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    c.select(k, line.alias("value")).repartitionByRange(parts, k).sortWithinPartitions(k).select("value").write.text(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")])
    surveyed = survey(spark, path)
    rows = read_surveyed(spark, path, schema, header=False, length_limits={"c_name": 25}, surveyed=surveyed)
    before = F.sum("lines").over(Window.orderBy(FILE_COL).rowsBetween(Window.unboundedPreceding, -1))       # a row a file
    files = file_encodings(surveyed).select(FILE_COL, F.coalesce(before, F.lit(0)).alias("before"))
    return rows.where(F.col(REJECT_COL).isNotNull()).join(files, FILE_COL).select(
        (F.col("before") + F.col(LINE_COL)).alias("line"), F.col(REJECT_COL).alias("reason"), "c_custkey")


def _reject_lines_sql() -> str:
    return """
WITH c AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 61 = 0 THEN chr(10) ELSE '' END || concat_ws(';', CAST(c_custkey AS VARCHAR),
           CASE WHEN c_custkey % 97 = 0 THEN c_name || ';x' WHEN c_custkey % 83 = 0 THEN c_name || ' of the long name' ELSE c_name END,
           CAST(c_nationkey AS VARCHAR), CASE WHEN c_custkey % 89 = 0 THEN 'MULTI' || chr(10) || 'LINE ' || c_mktsegment ELSE c_mktsegment END) AS line
  FROM customer),
p AS (SELECT k, string_split(line, chr(10)) AS parts FROM c),
u AS (SELECT k, i, parts[i] AS line FROM p, LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i)),
n AS (SELECT row_number() OVER (ORDER BY k, i) AS line_number, string_split(line, ';') AS t, line FROM u),
r AS (SELECT line_number, t, CASE WHEN len(t) <> 4 THEN 'field_count' WHEN length(t[2]) > 25 THEN 'too_long:c_name' END AS reason FROM n WHERE trim(line) <> '')
SELECT CAST(line_number AS BIGINT) AS line, reason, NULLIF(t[1], '') AS c_custkey FROM r WHERE reason IS NOT NULL"""


def full_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the same table twice (staged writes + pointer swap), read it once."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = stamp(o.select("o_orderkey", "o_orderstatus",
                        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
                        F.col("o_orderdate").cast("date").alias("o_orderdate")))
    root = scratch_path(spark, "reload")
    create_namespaces(spark, ["silver"])
    publish(spark, df, "silver.orders_reload", root)
    publish(spark, df, "silver.orders_reload", root)
    return spark.table("silver.orders_reload").drop("dwh_create_date")


def _full_reload_sql() -> str:
    return ("SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, "
            "CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")


FAILURE_STEM = "sdg_891"


def clean_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers of one table whose names are drawn out for some members, most of them too far for the clean column:
    rows loaded and rejected by reason and member, nothing lost."""
    spec = next(t for t in TABLES if t.stem == "outbound_departures")
    root = scratch_path(spark, "lengths")
    extract = wide_extract(lineitem_cube(spark, sf_dir), spec, 1)
    code = F.regexp_replace("C", "[^0-9]", "0").cast("long")
    drawn = (extract.withColumn("Basic_data", F.when(code % 5 == 1, F.rpad(F.lit("x"), 201, "y")).when(code % 5 == 2, F.rpad(F.lit("x"), 200, "y")).otherwise(F.col("Basic_data")))
                    .withColumn("Units", F.when(code % 7 == 3, F.rpad(F.lit("u"), 100, "v")).otherwise(F.col("Units"))))
    write_extract(drawn, f"{root}/in")
    wh = Warehouse(spark, f"{root}/tables", tables=(spec,), prefix="lengths_", max_reject_fraction=1.0)
    wh.load_raw({spec.stem: f"{root}/in"})
    wh.load_clean()
    good = spark.table("lengths_silver.outbound_departures").groupBy("Country_code").agg(F.count(F.lit(1)).alias("n")).withColumn("reason", F.lit(None).cast("string"))
    bad = wh.clean_rejects().select(F.get_json_object("row", "$.Country_code").cast("int").alias("Country_code"), F.col(REJECT_COL).alias("reason"))
    return good.select("Country_code", "reason", "n").union(bad.groupBy("Country_code", "reason").agg(F.count(F.lit(1)).alias("n")))


def _clean_lengths_sql() -> str:
    return """
WITH k AS (SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag FROM lineitem),
c AS (SELECT CASE WHEN l_suppkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey AS INTEGER) END AS Country_code,
             CASE WHEN l_suppkey % 97 <> 0 AND l_suppkey % 5 = 1 THEN 'too_long:Country' END AS reason FROM k)
SELECT Country_code, reason, count(*) AS n FROM c GROUP BY ALL"""


HISTORY_STEMS = ("domestic_trip", "sdg_891")


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of a small warehouse (two layers) read back from its history: one good load, one that fails in its raw layer for a
    rejected line, and one that is tried twice under its id. Times are compared, not returned: every table's lies
    within its layer's, in order, and lasts as long as it says."""
    chosen = tuple(t for t in TABLES if t.stem in HISTORY_STEMS)
    root = scratch_path(spark, "history")
    inputs = derive_raw_files(spark, sf_dir, f"{root}/extracts", tables=chosen)
    sdg = next(t for t in chosen if t.shape == "long")
    bad = long_extract(orders_by_year(spark, sf_dir), sdg)
    write_extract(bad.withColumn("Units", F.when(F.col("GeoAreaCode").cast("long") % 19 == 0, F.concat("Units", F.lit(";stray"))).otherwise(F.col("Units"))), f"{root}/bad")

    def warehouse(run_id):
        return Warehouse(spark, f"{root}/tables", tables=chosen, prefix="history_", run_id=run_id)

    def two_layers(wh):
        wh.load_raw(inputs)
        wh.load_clean()

    two_layers(warehouse("run-1"))
    try:
        warehouse("run-2").load_raw(inputs | {sdg.stem: f"{root}/bad"})
    except RejectThresholdExceeded:
        pass    # the history has it
    for _ in range(2):
        two_layers(warehouse("run-3"))
    found = warehouse("reader").load_history()
    whole = found.where(F.col("table_name") == WHOLE_LAYER).select("run_id", "layer", F.col("started").alias("_from"), F.col("ended").alias("_to"))
    lasted = F.col("ended").cast("double") - F.col("started").cast("double")
    timed = (F.col("started") <= F.col("ended")) & (F.col("started") >= F.col("_from")) & (F.col("ended") <= F.col("_to")) & (F.abs(lasted - F.col("seconds")) < 0.5)
    return found.join(whole, ["run_id", "layer"]).select("run_id", "layer", "table_name", "rows", "rejects", "status", "error_class", "error_severity", timed.alias("timed"))


def _load_history_sql() -> str:
    return f"""
WITH d AS (SELECT * FROM lineitem), k AS (SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag FROM d),
w AS (SELECT count(*) AS n FROM k),
c AS (SELECT l_suppkey, l_linenumber, l_returnflag, year(l_shipdate) AS y FROM d WHERE l_extendedprice IS NOT NULL GROUP BY ALL),
o AS (SELECT o_custkey AS k, year(o_orderdate) AS y FROM orders GROUP BY ALL),
s AS (SELECT count(*) AS n, count(*) FILTER (WHERE k % 19 = 0) AS bad FROM o),
loaded AS (
  SELECT layer, t AS table_name, n AS rows FROM w, (VALUES ('raw', 'domestic_trip'), ('clean', 'domestic_trip')) v(layer, t)
  UNION ALL SELECT layer, t, n FROM s, (VALUES ('raw', 'sdg_891'), ('clean', 'sdg_891')) v(layer, t)),
ok AS (SELECT r AS run_id, layer, table_name, rows, CAST(0 AS BIGINT) AS rejects FROM loaded, (VALUES ('run-1'), ('run-3')) v(r)),
layers AS (SELECT * FROM ok UNION ALL SELECT run_id, layer, '*', CAST(sum(rows) AS BIGINT), CAST(0 AS BIGINT) FROM ok GROUP BY ALL)
SELECT run_id, layer, table_name, rows, rejects, 'ok' AS status, CAST(NULL AS VARCHAR) AS error_class, CAST(NULL AS VARCHAR) AS error_severity, true AS timed FROM layers
UNION ALL SELECT 'run-2', 'raw', 'domestic_trip', n, 0, 'ok', NULL, NULL, true FROM w
UNION ALL SELECT 'run-2', 'raw', t, NULL, NULL, 'failed', 'RejectThresholdExceeded', 'input', true FROM (VALUES ('sdg_891'), ('*')) v(t)"""


def load_failure_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of a load that must fail: an SDG extract of ``orders`` in which every
    19th customer's lines have a field too many, and no rejected line is allowed."""
    root = scratch_path(spark, "failure")
    spec = next(t for t in TABLES if t.stem == FAILURE_STEM)
    df = long_extract(orders_by_year(spark, sf_dir), spec)
    stray = F.col("GeoAreaCode").cast("long") % 19 == 0
    write_extract(df.withColumn("Units", F.when(stray, F.concat("Units", F.lit(";stray"))).otherwise(F.col("Units"))),
                  f"{root}/{spec.stem}")
    wh = Warehouse(spark, f"{root}/tables", tables=(spec,), prefix="failure_")
    try:
        wh.load_raw({spec.stem: f"{root}/{spec.stem}"})
    except RejectThresholdExceeded:
        pass    # the audit has it
    return wh.audit_frame().drop(*TIMES, "error_line")


def _load_failure_sql() -> str:
    return f"""
WITH l AS (SELECT o_custkey AS k FROM orders GROUP BY o_custkey, year(o_orderdate)),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE k % 19 = 0) AS r FROM l)
SELECT 'raw' AS layer, t AS table_name, CAST(NULL AS BIGINT) AS rows, CAST(NULL AS BIGINT) AS rejects,
       'failed' AS status, 'RejectThresholdExceeded: ' || r || ' of ' || n || ' rows rejected in {FAILURE_STEM}' AS error,
       'RejectThresholdExceeded' AS error_class, '-' AS error_condition, '-' AS error_state, 'run' AS error_procedure, 'input' AS error_severity
FROM c, (VALUES ('{FAILURE_STEM}'), ('*')) v(t)"""


def define_then_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table declared (twice: the second keeps the first), empty until it is loaded,
    then rows, sum and load stamps per order status."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = stamp(o.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")))
    root, table = scratch_path(spark, "defined"), "silver.orders_defined"
    create_namespaces(spark, ["silver"])
    define_table(spark, table, df.schema, version_path(root, table, "empty"), replace=True)
    define_table(spark, table, df.schema, version_path(root, table, "other"))
    before = spark.table(table).count()
    publish(spark, df, table, root)
    return spark.table(table).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").cast("decimal(38,2)").alias("total"),
        F.count_distinct("dwh_create_date").alias("stamps"),
        F.sum(F.col("dwh_create_date").isNull().cast("long")).alias("unstamped"),
    ).withColumn("rows_before", F.lit(before).cast("long"))


def _define_then_load_sql() -> str:
    return ("SELECT o_orderstatus, count(*) AS rows, "
            "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total, CAST(1 AS BIGINT) AS stamps, "
            "CAST(0 AS BIGINT) AS unstamped, CAST(0 AS BIGINT) AS rows_before FROM orders GROUP BY o_orderstatus")


PIPELINE_QUERIES = {
    "define_then_load": define_then_load,
    "load_failure_audit": load_failure_audit,
    "load_history": load_history,
    "clean_lengths": clean_lengths,
    "csv_scan_roundtrip": csv_scan_roundtrip,
    "encoding_repair": encoding_repair,
    "reject_lines": reject_lines,
    "fact_grain": fact_grain,
    "full_reload": full_reload,
    "load_audit": load_audit,
    "star_aliases": star_aliases,
    "virtual_star": virtual_star,
    "catalog_years": catalog_years,
    "warehouse_facts": warehouse_facts,
}

def _csv_scan_sql() -> str:
    """Same text lines, split at line breaks and at ';' (no quoting), empty
    fields as NULL, first four fields kept, reject reasons in the same order."""
    return """
WITH c AS (
  SELECT CAST(c_custkey AS VARCHAR) AS k,
         CASE WHEN c_custkey % 97 = 0 THEN c_name || ';x'
              WHEN c_custkey % 83 = 0 THEN c_name || ' of the long name'
              ELSE c_name END AS nm,
         CAST(c_nationkey AS VARCHAR) AS nk,
         CASE WHEN c_custkey % 89 = 0 THEN 'MULTI' || chr(10) || 'LINE ' || c_mktsegment
              ELSE c_mktsegment END AS seg
  FROM customer),
l AS (SELECT concat_ws(';', COALESCE(k, ''), COALESCE(nm, ''), COALESCE(nk, ''), COALESCE(seg, '')) AS line
      FROM c),
p AS (SELECT unnest(string_split(line, chr(10))) AS pl FROM l),
f AS (SELECT string_split(pl, ';') AS t FROM p)
SELECT NULLIF(t[1], '') AS c_custkey, NULLIF(t[2], '') AS c_name, NULLIF(t[3], '') AS c_nationkey,
       NULLIF(t[4], '') AS c_mktsegment,
       CASE WHEN len(t) <> 4 THEN 'field_count'
            WHEN length(NULLIF(t[2], '')) > 25 THEN 'too_long:c_name' END AS _reject_reason
FROM f"""


PIPELINE_ORACLE = {"catalog_years": _catalog_years_sql, "clean_lengths": _clean_lengths_sql, "load_history": _load_history_sql, "encoding_repair": _encoding_repair_sql, "reject_lines": _reject_lines_sql, "full_reload": _full_reload_sql, "csv_scan_roundtrip": _csv_scan_sql,
                   "define_then_load": _define_then_load_sql, "load_failure_audit": _load_failure_sql}
