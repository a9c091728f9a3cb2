"""Fill-in-the-middle transformation by one repeated-capture match a text.

One ``regex`` fullmatch of ``(unit)*`` retains every repetition of its group:
``match.ends(1)`` is the list of all unit ends, so its length is the number of
units and two of its entries are the cut offsets. The two cuts, whether a
document is transformed and in which order are read off a hash of ``seed`` and
``doc_id``, so reruns agree. Prefix ends after the smaller drawn number of
units, middle after the larger. ``psm``: ``<P>prefix<S>suffix<M>middle``; ``spm``:
``<S>suffix<P>prefix<M>middle``; ``plain``: the text itself. No marker may overlap
another or itself, so ``restored`` splits an output at its markers.

Texts go through a scan's tasks one by one; nothing is shuffled. A match takes
about 100 bytes a unit, so a text longer than ``WINDOW`` characters is matched
window by window, each from where the last whole unit of the one before ends
(a unit longer than a window widens it).

Edge cases: a null text is empty; empty texts, texts that hold a marker, and
texts that units don't cover (``n`` null) are plain, with null cut lengths; a
null ``doc_id`` is hashed as the empty string; repeated rows get equal results;
kept columns may have any name; an empty table gives no row.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import ship_code

MARKERS = ("<P>", "<S>", "<M>")
#: Any code point, line breaks included.
CODE_POINT = r"(?s:.)"
WINDOW = 1 << 18
#: Percent of documents transformed, and percent of these in suffix-prefix-middle order.
RATE, SPM = 90, 20


def unit_pattern(unit: str = CODE_POINT) -> regex.Pattern:
    """``(unit)*`` with the unit as its only group; a unit is never empty."""
    pattern = regex.compile(f"({unit})*")
    if pattern.groups != 1:
        raise ValueError("a unit must not hold groups of its own")
    if regex.fullmatch(unit, ""):
        raise ValueError("a unit must not be empty")
    return pattern


def unit_ends(pattern: regex.Pattern, text: str, window: int = WINDOW) -> np.ndarray | None:
    """End offset of every unit of ``text``; None if units don't cover it."""
    if len(text) <= window:
        m = pattern.fullmatch(text)
        return None if m is None else np.array(m.ends(1), np.int64)
    out, low, width = [], 0, window
    while low < len(text):
        high = min(len(text), low + width)
        ends = pattern.match(text, low, high).ends(1)
        if high < len(text):
            ends = ends[:-1]                    # the window may have cut the last unit short
            if not ends:
                width *= 2
                continue
        elif not ends or ends[-1] != high:
            return None
        out.append(np.array(ends, np.int64))
        low, width = ends[-1], window
    return np.concatenate(out)


def check_markers(markers: tuple[str, str, str]) -> None:
    """Raises unless every output can be split at its markers alone."""
    if len(set(markers)) < 3 or not all(markers):
        raise ValueError("three different markers are needed")
    for a, b in product(markers, repeat=2):
        if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
            raise ValueError(f"markers {a!r} and {b!r} overlap")


def transformed(text: str, h: tuple[int, int, int, int], pattern: regex.Pattern, markers=MARKERS, rate: int = RATE, spm: int = SPM):
    """``n, form, prefix_end, middle_end, output`` of a text; ``h``: two cuts, whether, which order."""
    ends = unit_ends(pattern, text)
    n = None if ends is None else len(ends)
    if not n or h[2] % 100 >= rate or any(m in text for m in markers):
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (int(ends[i - 1]) if i else 0 for i in (low, high))
    p, s, m = markers
    if h[3] % 100 < spm:
        return n, "spm", a, b, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return n, "psm", a, b, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def draws(doc_id: Column, seed: int) -> Column:
    """The first four 8-digit groups of the hash of ``seed:doc_id`` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)))


def fill_in_middle(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), seed: int = 1, unit: str = CODE_POINT,
                   markers: tuple[str, str, str] = MARKERS, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Columns ``row`` (struct of ``keep``), ``n`` (units), ``form``, ``prefix_end``, ``middle_end`` (offsets in code points, null if plain)
    and ``output`` of every row of ``docs(doc_id, text)``."""
    check_markers(markers)
    unit_pattern(unit)
    ship_code(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("row"), draws(F.col("doc_id"), seed).alias("h"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        pattern = unit_pattern(unit)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                got = [transformed(t, h, pattern, markers, rate, spm) for h, t in zip(some.column(1).to_pylist(), some.column(2).to_pylist())]
                n, form, a, b, output = zip(*got)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()),
                                                  pa.array(b, pa.int64()), pa.array(output, pa.string())],
                                                 names=["row", "n", "form", "prefix_end", "middle_end", "output"])

    out = T.StructType([rows.schema["row"]]).add("n", "long").add("form", "string").add("prefix_end", "long").add("middle_end", "long").add("output", "string")
    return rows.mapInArrow(run, out)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text, put together again from an output and its form."""
    cut = "|".join("".join(f"\\u{unit:04x}" for unit in np.frombuffer(m.encode("utf-16-le"), "<u2")) for m in markers)
    part = F.split(output, cut, -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM documents),
h AS (
  SELECT *, CAST('0x' || x[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || x[9:16] AS BIGINT) % (n + 1) AS c2,
         CAST('0x' || x[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || x[25:32] AS BIGINT) % 100 AS h4
  FROM d),
f AS (
  SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
