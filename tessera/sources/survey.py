"""Files surveyed before they are read: encodings found out, lines numbered.

``survey`` scans the files once, in parallel splits and without decoding, and
gives a row a split: its lines, the lines of its file before it (a sum over the
splits in front), and the encoding of its file. ``read_surveyed`` scans again,
decodes each line by the verdict on its file, splits it at its separators with
the fixed positional layout, and knows of every row the file and line it comes
from, so a reject can be looked up in the file. No row is shuffled for
that: a row's place in its split is its running number less that of the
split's first line, and the survey, a row a split, is joined by broadcast while
its measured size allows.

The running numbers of both scans are the same as long as the same files are cut
in the same way (they depend on file sizes and session settings). Each row is
checked against its split's line count, and a file that changed in between, or
was cut otherwise, ends the job instead of giving wrong numbers.

Encodings, by file (one line can't tell: bytes may be valid in two ways):

* ``utf-8``: every line with bytes above 127 is UTF-8, and not mostly misread;
* ``utf-8 misread as <page>``: UTF-8, but at least half of the lines with high
  characters turn back into UTF-8 by a code page (the one that turns back most):
  some tool read the file in that page and wrote what it saw;
* ``<page>``: some line is not UTF-8; the page that gives most letters in places
  where letters stand.

A header is line 1 of every file; blank lines are passed over, but counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.encoding import PAGES, from_bytes, plausible, utf8_of
from tessera.session import ensure_checkpoint_dir
from tessera.sources.delimited import CORRUPT_COL, csv_options, with_reject_reason

UTF8 = "utf-8"
FILE_COL, LINE_COL = "_file", "_line_number"
#: Bytes of a survey row in a hash table, with its path and encoding.
ROW_BYTES = 400


class SurveyError(RuntimeError):
    pass


def misread_as(page: str) -> str:
    return f"{UTF8} misread as {page}"


def _lines(spark: SparkSession, path) -> DataFrame:
    """Every line as bytes (the text source leaves them as they are), its file, split and running number."""
    return spark.read.text(path).select(F.col("value").cast("binary").alias("_bytes"), F.col("_metadata.file_path").alias(FILE_COL),
                                        F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"))


def survey(spark: SparkSession, path, pages: tuple = PAGES) -> DataFrame:
    """A row a split of the files under ``path``: file, split, lines, first number, lines before, encoding (``pages`` empty: UTF-8)."""
    lines = _lines(spark, path)
    text = F.col("_bytes").cast("string")
    counts = [F.count(F.lit(1)).alias("lines"), F.min("_at").alias("first"), F.max("_at").alias("last")]
    if pages:
        valid = F.is_valid_utf8(text)
        high = ~valid | (F.length(text) != F.octet_length(text))      # holds a byte above 127; a UTF-8 character that isn't ASCII has several
        # a line is UTF-8 if its runs of high characters are: only these are tried in each page
        runs = F.regexp_replace(text, "[\\x00-\\x7F]+", " ")
        lines = lines.select(FILE_COL, "_split", "_at", high.alias("_is_high"), F.when(high & valid, runs).alias("_runs"), F.when(~valid, F.col("_bytes")).alias("_odd"))
        counts += [F.count_if("_is_high").alias("high"), F.count("_runs").alias("utf8")]
        counts += [F.count(utf8_of("_runs", p)).alias(f"back_{i}") for i, p in enumerate(pages)]
        counts += [F.coalesce(F.sum(F.when(F.col("_odd").isNotNull(), plausible(from_bytes("_odd", p)))), F.lit(0)).alias(f"good_{i}") for i, p in enumerate(pages)]
    splits = lines.groupBy(FILE_COL, "_split").agg(*counts)
    if pages:
        n = range(len(pages))
        whole = Window.partitionBy(FILE_COL)
        sums = {c: F.sum(c).over(whole) for c in ("high", "utf8", *(f"{k}_{i}" for k in ("back", "good") for i in n))}
        splits = splits.select(FILE_COL, "_split", "lines", "first", "last", *[s.alias(c) for c, s in sums.items()])
        back, good = (F.greatest(*[F.col(f"{k}_{i}") for i in n]) if len(pages) > 1 else F.col(f"{k}_0") for k in ("back", "good"))
        misread, page = F.lit(None).cast("string"), F.lit(None).cast("string")
        for i, p in reversed(list(enumerate(pages))):
            misread = F.when(F.col(f"back_{i}") == back, F.lit(misread_as(p))).otherwise(misread)
            page = F.when(F.col(f"good_{i}") == good, F.lit(p)).otherwise(page)
        encoding = (F.when(F.col("utf8") < F.col("high"), page)
                    .when((F.col("high") > 0) & (2 * back >= F.col("high")), misread).otherwise(F.lit(UTF8)))
    else:
        encoding = F.lit(UTF8)
    before = F.sum("lines").over(Window.partitionBy(FILE_COL).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    found = splits.select(FILE_COL, "_split", "lines", "first", F.coalesce(before, F.lit(0)).alias("before"), encoding.alias("encoding"),
                          (F.col("last") - F.col("first") + 1 == F.col("lines")).alias("whole"))
    ensure_checkpoint_dir(spark)
    return found.checkpoint(eager=True)


def file_encodings(surveyed: DataFrame) -> DataFrame:
    """``file, lines, encoding`` of every file of a survey."""
    return surveyed.groupBy(FILE_COL).agg(F.sum("lines").alias("lines"), F.first("encoding").alias("encoding"))


def decoded(line: Column, encoding: Column, pages: tuple = PAGES) -> Column:
    """Text of a line of bytes in an encoding that a survey names; a line that was not misread is left as it is."""
    text = line.cast("string")
    out = text
    for p in pages:
        out = F.when(encoding == p, from_bytes(line, p)).when(encoding == misread_as(p), F.coalesce(utf8_of(text, p), text)).otherwise(out)
    return out


def numbered_lines(spark: SparkSession, path, surveyed: DataFrame | None = None, pages: tuple = PAGES,
                   max_broadcast_bytes: int | None = None) -> DataFrame:
    """``_line`` (text), ``_file``, ``_line_number`` (from 1 in its file) and ``_encoding`` of every line under ``path``."""
    from tessera.operators.star import broadcast_budget

    surveyed = survey(spark, path, pages) if surveyed is None else surveyed
    budget = broadcast_budget(spark) if max_broadcast_bytes is None else max_broadcast_bytes
    side = F.broadcast(surveyed) if surveyed.count() * ROW_BYTES <= budget else surveyed
    rows = _lines(spark, path).join(side, [FILE_COL, "_split"], "left")
    place = F.col("_at") - F.col("first")
    wrong = F.col("first").isNull() | ~F.col("whole") | (place < 0) | (place >= F.col("lines"))
    number = (F.when(wrong, F.raise_error(F.concat(F.lit("not as surveyed, changed or cut otherwise: "), F.col(FILE_COL))).cast("long"))
              .otherwise(F.col("before") + place + 1))
    return rows.select(decoded(F.col("_bytes"), F.col("encoding"), pages).alias("_line"), FILE_COL, number.alias(LINE_COL), F.col("encoding").alias("_encoding"))


def read_surveyed(spark: SparkSession, path, schema: T.StructType, *, sep: str = ";", header: bool = True, quote: str | None = "",
                  length_limits: dict | None = None, surveyed: DataFrame | None = None, pages: tuple = PAGES) -> DataFrame:
    """``read_delimited`` with each file in its own encoding: columns of ``schema``, the raw line of
    malformed rows, the reject reason, and ``_file`` and ``_line_number`` of every row."""
    lines = numbered_lines(spark, path, surveyed, pages).where(F.col("_line").rlike("[^\\x00-\\x20]"))
    if header:
        lines = lines.where(F.col(LINE_COL) > 1)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])
    ddl = ", ".join(f"`{f.name}` STRING" for f in full.fields)
    parsed = lines.select(F.from_csv(F.col("_line"), ddl, {k: str(v) for k, v in csv_options(sep, quote).items()}).alias("_row"), FILE_COL, LINE_COL)
    return with_reject_reason(parsed.select("_row.*", FILE_COL, LINE_COL), schema, length_limits, keep=(FILE_COL, LINE_COL))
