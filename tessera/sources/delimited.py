"""Delimited-file scans with a fixed positional schema and a reject column.

Files are read once, in parallel splits, with the declared all-text schema
(columns bind by position; the header line is skipped, not matched).
Malformed lines (too many or too few fields) and values longer than their
declared limit are not dropped: they are kept with a reject reason so one
pass feeds both the loaded rows and the reject report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"
REJECT_COL = "_reject_reason"


def csv_options(sep: str, quote: str | None) -> dict:
    """How a line is split at its separators, by a scan or by an expression."""
    out = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL,
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return out if quote is None else out | {"quote": quote}


def _configure(reader, schema: T.StructType, sep: str, header: bool, quote: str | None,
               encoding: str):
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    # With CSV column pruning the parser only tokenises the columns a query
    # reads, and a line's field count is then checked against that subset:
    # the same line can be good for one query and malformed for another.
    # Reject detection needs the full positional layout, so this scan has it off.
    return reader.schema(full).options(header=header, encoding=encoding, columnPruning=False, **csv_options(sep, quote))


def with_reject_reason(df: DataFrame, schema: T.StructType, length_limits: dict | None = None, keep: tuple = ()) -> DataFrame:
    """Declared columns, the raw line of malformed rows, the reject reason, and the columns ``keep``."""
    reason = F.when(F.col(CORRUPT_COL).isNotNull(), F.lit("field_count"))
    for name, limit in (length_limits or {}).items():
        if name in schema.fieldNames():
            reason = reason.when(F.length(name) > limit, F.lit(f"too_long:{name}"))
    return df.select(*schema.fieldNames(), F.col(CORRUPT_COL).alias("_raw_line"),
                     reason.alias(REJECT_COL), *keep)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ";",
                   header: bool = True, quote: str | None = "", encoding: str = "UTF-8",
                   length_limits: dict | None = None, stream: bool = False,
                   options: dict | None = None) -> DataFrame:
    """Scan ``path`` into ``schema`` plus ``_reject_reason`` (NULL = good row).

    ``quote=""`` keeps quote characters as data and splits at every
    separator, the way a plain field-terminator load does; pass ``'"'`` to
    treat double quotes as text qualifiers instead. ``stream=True`` returns
    the same columns from a file-source stream over the directory.
    """
    base = spark.readStream if stream else spark.read
    reader = _configure(base, schema, sep, header, quote, encoding)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    return with_reject_reason(df, schema, length_limits)


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT_COL).isNull()).drop(REJECT_COL, "_raw_line", "_file", "_line_number")


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT_COL).isNotNull())


def spec_length_limits(schema: T.StructType, limits: dict, year_limit: int | None = None) -> dict:
    out = {n: v for n, v in limits.items() if n in schema.fieldNames()}
    if year_limit:
        out.update({n: year_limit for n in schema.fieldNames() if n.startswith("year_")})
    return out
