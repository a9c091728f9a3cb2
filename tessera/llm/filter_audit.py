"""Filter interaction audit by sorted posting lists.

Every document gets a row number; numbers are cut into ranges of ``RANGE``. For
each part, filter and range the numbers of the failing documents are kept as a
sorted list (and, as lists of their own, those of the marked documents). A
k-way merge walks the lists of a part and range together: at the least number
it either stands in one list alone, and a gallop (doubling steps, then
bisection) takes the whole run up to the next number of another list, or in
several, which are advanced together. The lengths of the runs by the set of
lists that hold them give the sizes of all unions and differences of the range:
what a filter removes after a set of others is its list without their union.
Sizes are summed over ranges, and read for every order of the filters.

A range bounds every list, so a part that holds all documents is many ranges;
nothing but sizes leaves a range. Copies and labels are met by ``spread_join``.

Edge cases: a null text is empty; a null part is the empty string; repeated
rows are documents of their own (numbers, not ids, stand in the lists); a null
``doc_id`` has no label and is no copy of another (nor another of it); a
``doc_id`` with several label rows is marked if one of them says so; extra
columns are ignored; a part without failing documents has rows of zeros; an
empty table gives none.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship_code, spread_join

FILTERS = "ABCDE"
#: Row numbers of a range, as a number of bits.
RANGE = 14
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 3, b"#$%&*|"
_CAPITALS, _INNER = bytes(range(65, 91)), bytes(range(0x80, 0xC0))


def text_fails(text: bytes) -> int:
    """Bits of the filters A to D that a text (UTF-8) fails."""
    words = text.split()                        # bytes split at ASCII white space
    points = len(text) - _count(text, _INNER)
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * _count(text, _CAPITALS) > CAPITAL_PERCENT * points) << 2 | (_count(text, SYMBOLS) > 0) << 3)


def _count(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


def checked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, good, toxic`` of ``docs(doc_id, text, lang)`` under filters A to E (E: a smaller doc_id has the text)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                texts = [t or b"" for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(map(text_fails, texts), pa.int32()),
                                                  pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                                                 names=["part", "doc_id", "fails", "digest"])

    ship_code(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    rows = materialise(rows.mapInArrow(run, "part string, doc_id long, fails int, digest binary"), "audit-checked")
    first = materialise(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"),
                        "audit-copies")
    copied = materialise(spread_join(rows, first, "digest").select(
        "part", "doc_id", (F.col("fails") + F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)).alias("fails")), "audit-copied")

    def marked(c):
        return F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias("good" if c == "quality" else c)

    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(
        marked("quality"), marked("toxic"))
    return spread_join(copied, marks, "doc_id").select("part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def posting_lists(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, range, list, ids``: the sorted row numbers of ``rows(part, fails, good, toxic)`` that fail filter ``list``, or, as the
    last two lists, are good and toxic."""
    numbered = materialise(rows.withColumn("id", F.monotonically_increasing_id()), "audit-numbered")       # written, so that numbers stay
    k = len(filters)
    lists = [F.when(F.col("fails").bitwiseAND(F.lit(1 << i)) != 0, F.lit(i)) for i in range(k)]
    lists += [F.when(F.col(c), F.lit(k + i)) for i, c in enumerate(("good", "toxic"))]
    spread = numbered.select("part", F.shiftright("id", RANGE).alias("range"), "id", F.explode(F.array_compact(F.array(*lists))).alias("list"))
    return spread.groupBy("part", "range", "list").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def gallop(ids: Sequence[int], low: int, x: int) -> int:
    """First place from ``low`` on that holds ``x`` or more: doubling steps, then bisection within the last one."""
    step = 1
    while low + step < len(ids) and ids[low + step] < x:
        low, step = low + step, 2 * step
    return bisect_left(ids, x, low, min(len(ids), low + step))


def merged_runs(lists: Sequence[Sequence[int]]) -> Iterator[tuple[int, int]]:
    """Merge of sorted lists: the set of lists that hold a run of numbers (as bits), and the run's length."""
    at = {i: 0 for i, ids in enumerate(lists) if ids}
    while at:
        heads = {i: lists[i][p] for i, p in at.items()}
        least = min(heads.values())
        own = [i for i, x in heads.items() if x == least]
        if len(own) == 1:
            one = own[0]
            other = min((x for i, x in heads.items() if i != one), default=None)
            end = len(lists[one]) if other is None else gallop(lists[one], at[one], other)
            yield 1 << one, end - at[one]
            at[one] = end
        else:
            yield sum(1 << i for i in own), 1
            for i in own:
                at[i] += 1
        for i in own:
            if at[i] == len(lists[i]):
                del at[i]


def differences(lists: Sequence[Sequence[int]], k: int) -> np.ndarray:
    """For every filter (of the first ``k`` lists) and set of others: size of its list without their union, and of
    what of that stands in each of the two lists of marks. Rows as ``pairs(k)``."""
    sizes = np.zeros(1 << (k + 2), np.int64)
    for held, n in merged_runs(lists):
        sizes[held] += n
    held = np.arange(len(sizes))
    out = []
    for before, one in pairs(k):
        removed = (held >> one & 1 == 1) & (held & before == 0)
        out.append([sizes[removed].sum(), sizes[removed & (held >> k & 1 == 1)].sum(), sizes[removed & (held >> (k + 1) & 1 == 1)].sum()])
    return np.array(out, np.int64).reshape(-1, 3)


def pairs(k: int) -> list[tuple[int, int]]:
    """Every set of filters (as bits) and filter that is not in it."""
    return [(s, i) for s in range(1 << k) for i in range(k) if not s >> i & 1]


def summed_sizes(lists: DataFrame, parts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, before, filter, removed, good_lost, toxic_lost`` of every part and pair of a set of filters and another."""
    k = len(filters)
    names = ["removed", "good_lost", "toxic_lost"]
    every = pairs(k)

    def run(key, table):
        import pyarrow as pa

        ids: list[list[int]] = [[] for _ in range(k + 2)]
        for i, values in zip(table.column("list").to_pylist(), table.column("ids")):
            ids[i] = values.values.to_numpy().tolist()
        sizes = differences(ids, k)
        before, one = zip(*every)
        part = pa.array([key[0].as_py()] * len(every), pa.string())
        return pa.Table.from_arrays([part, pa.array(before, pa.int32()), pa.array(one, pa.int32()), *map(pa.array, sizes.T)], names=["part", "before", "filter", *names])

    found = lists.groupBy("part", "range").applyInArrow(run, "part string, before int, filter int, removed long, good_lost long, toxic_lost long")
    none = parts.select("part", F.explode(F.array(*(F.struct(F.lit(s).alias("before"), F.lit(i).alias("filter")) for s, i in every))).alias("x")).select(
        "part", "x.before", "x.filter", *(F.lit(0).cast("long").alias(n) for n in names))
    return found.union(none).groupBy("part", "before", "filter").agg(*(F.sum(n).alias(n) for n in names))


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Removals of every part, order of the filters and step; ``rows(part, fails, good, toxic)``, bit i of ``fails`` for ``filters[i]``."""
    spark, k = rows.sparkSession, len(filters)
    if not 1 <= k <= 7 or len(set(filters)) < k:
        raise ValueError("one to seven filters, each named by a letter of its own")
    ship_code(spark)
    rows = materialise(rows.select("part", "fails", "good", "toxic"), "audit-rows")
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("docs"))
    lists = materialise(posting_lists(rows, filters), "audit-postings")
    sizes = materialise(summed_sizes(lists, parts, filters), "audit-sizes")
    full = (1 << k) - 1
    size = F.bit_count("before")
    orders_of = F.element_at(F.array(*(F.lit(factorial(n) * factorial(k - 1 - n)).cast("long") for n in range(k))), size + 1)
    alone = sizes.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") == full - F.expr("shiftleft(1, `filter`)"), F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders_of).alias("shapley"))
    steps = spark.createDataFrame([("".join(filters[i] for i in p), n + 1, sum(1 << i for i in p[:n]), p[n]) for p in permutations(range(k)) for n in range(k)],
                                  "filter_order string, step int, before int, filter int")
    taken = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    return (sizes.join(F.broadcast(steps), ["before", "filter"]).join(alone, ["part", "filter"]).join(parts, "part")
            .select("part", "filter_order", "step", (F.col("docs") - taken).alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
                    "unique_fails", "good_lost", "toxic_lost", "shapley"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END AS a, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 1 ELSE 0 END AS b,
         CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 1 ELSE 0 END AS c,
         CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 1 ELSE 0 END AS x, CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 1 ELSE 0 END AS e
  FROM d LEFT JOIN l USING (doc_id)),
cells AS (
  SELECT part, a + 2 * b + 4 * c + 8 * x + 16 * e AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
one AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
orders AS (
  SELECT p.letter || q.letter || r.letter || s.letter || u.letter AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM one p, one q, one r, one s, one u WHERE p.bit | q.bit | r.bit | s.bit | u.bit = 31),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM orders, generate_series(1, 5) g(step)),
counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN fails & (before | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & own <> 0 AND fails & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
