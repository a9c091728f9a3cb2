"""Stupid-backoff language model scores from corpus-wide n-gram counts.

Score of a word after its context: c(context word) / c(context) for the longest
context whose n-gram occurs, times 0.4 for every longer one that doesn't; a
word that doesn't occur at all counts as 1 in (words + 1). All counts leave the
scored document out, so a text isn't scored by itself.

As a job: documents are dealt to blocks by hash; a block explodes its n-grams,
counts them, and sends each hash range the sorted distinct n-gram hashes of each order
 with their counts, packed into arrays (byte planes of the differences,
which the shuffle's compression shrinks). A range adds the counts of all blocks
up (the count tables, partitioned by hash) and sends every block the totals of
the n-grams it asked for, in the same order. The block joins them to its
n-grams and sums the scores of each document. Frequent n-grams are counted
before the shuffle, so none is a hot key; no part of the tables goes to the
driver. Words are runs of anything but ASCII white space, with A-Z in lower
case; n-grams are named by hashes of 56 bits (of n n-grams, one shares its name
with another with probability n / 2^56).

Scores are sums of integers (millionths of a nat a word), so they do not depend
on the order of addition. Edge cases: a null text has no word, score 0 and a
null mean; repeated rows are documents of their own; a null ``doc_id`` is
scored; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, ship_code

ORDER, BACKOFF = 3, 0.4
NAME_BITS = 56
LOW = 4             # byte planes of hash differences that are noise
BLOCKS = 2          # blocks, and hash ranges, a shuffle partition
MICRO = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * _ODD + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _planes(values: np.ndarray, plain: int = 0) -> bytes:
    """The values' bytes, lowest bytes of all values first; all but the ``plain`` lowest planes are deflated."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return planes[:plain].tobytes() + zlib.compress(planes[plain:], 1)


def _from_planes(data: bytes, kind, n: int, plain: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data[:plain * n] + zlib.decompress(data[plain * n:]), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class Block:
    """The n-grams of some texts (bytes); ``grams[k]`` and ``at[k]``: hashes of the k-grams and the words where they end."""

    def __init__(self, texts: list[bytes | None], order: int):
        from xxhash import xxh64_intdigest

        arrays = [np.array(list(map(xxh64_intdigest, t.lower().split())), np.uint64) if t else np.zeros(0, np.uint64) for t in texts]
        self.sizes = np.array([len(a) for a in arrays], np.int64)
        words = np.concatenate([np.zeros(0, np.uint64), *arrays])
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.place = np.arange(len(words)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.grams, self.at = {}, {}
        whole = words
        for k in range(1, order + 1):
            if k > 1:
                whole = np.concatenate((whole[:1], _mix(whole[:-1], words[1:])))
            self.at[k] = np.flatnonzero(self.place >= k - 1)
            self.grams[k] = whole[self.at[k]] >> np.uint64(64 - NAME_BITS)


def _edges(parts: int) -> np.ndarray:
    """Lower ends of the hash ranges."""
    return np.array([(i << NAME_BITS) // parts for i in range(parts)], np.uint64)


def _asked(block: Block, order: int, parts: int):
    """For each hash range: (part, n, hashes, counts), lists by order; order 0 holds the block's number of words in range 0."""
    edges = _edges(parts)
    names, counts, bounds = [], [], []
    for k in range(1, order + 1):
        x, c = np.unique(block.grams[k], return_counts=True)
        names.append(x)
        counts.append(c.astype(np.uint64))
        bounds.append(np.append(np.searchsorted(x, edges), len(x)).tolist())
    for p in range(parts):
        some = [slice(b[p], b[p + 1]) for b in bounds]
        n = [int(p == 0), *(s.stop - s.start for s in some)]
        if any(n):
            yield (p, n, [_planes(np.zeros(n[0], np.uint64), LOW), *(_planes(np.diff(x[s], prepend=edges[p]), LOW) for x, s in zip(names, some))],
                   [_planes(np.full(n[0], block.sizes.sum(), np.uint64)), *(_planes(c[s]) for c, s in zip(counts, some))])


def _added_up(names: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """Total of each name over all arrays, for each array's names."""
    distinct, which = np.unique(np.concatenate(names), return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, which, np.concatenate(counts))
    return np.split(total[which], np.cumsum([len(n) for n in names])[:-1])


def _scores(block: Block, totals: list[np.ndarray], order: int):
    """Per document: score in millionths, words by the order that gave their score (0 to order)."""
    n = len(block.doc)
    score = np.zeros(len(block.sizes), np.int64)
    used = np.zeros((len(block.sizes), order + 1), np.int64)
    if not n:
        return score, used
    words = (int(totals[0][0]) - block.sizes)[block.doc]
    best = np.zeros(n, np.int64)
    ratio = 1.0 / (words + 1.0)
    shorter = words                        # count of the context of each k-gram, by the word where it ends
    for k in range(1, order + 1):
        names, which = np.unique(block.grams[k], return_inverse=True)
        if len(names) != len(totals[k]):
            raise ValueError("totals don't match the block's n-grams")
        own = _mix(block.grams[k], block.doc[block.at[k]].astype(np.uint64))
        _, same, times = np.unique(own, return_inverse=True, return_counts=True)
        count = np.zeros(n, np.int64)
        if len(names):
            count[block.at[k]] = totals[k].astype(np.int64)[which] - times[same]
        hit = np.flatnonzero(count > 0)
        best[hit] = k
        ratio[hit] = count[hit] / shorter[hit].astype(np.float64)
        shorter = np.concatenate(([0], count[:-1]))
    most = np.minimum(block.place + 1, order)                       # longest n-gram that ends at a word
    value = np.rint(MICRO * (np.log(ratio) + (most - best) * math.log(BACKOFF))).astype(np.int64)
    np.add.at(score, block.doc, value)
    np.add.at(used, (block.doc, best), 1)
    return score, used


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, log_score (nats), used (words by order of the n-gram that scored them, unseen first) of each row."""
    spark = docs.sparkSession
    ship_code(spark)
    parts = BLOCKS * partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")).repartition(parts, "block")

    def ask(table):
        import pyarrow as pa

        block = Block(table["text"].to_pylist(), order)
        part, n, names, counts = zip(*_asked(block, order, parts))
        arrays = pa.list_(pa.binary())
        return pa.Table.from_arrays([pa.array(part, pa.int32()), pa.array([table["block"][0].as_py()] * len(part), pa.int32()),
                                     pa.array(n, pa.list_(pa.int32())), pa.array(names, arrays), pa.array(counts, arrays)],
                                    names=["part", "block", "n", "names", "counts"])

    def add_up(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        first = _edges(parts)[table["part"][0].as_py()]
        sizes, totals = table["n"].to_pylist(), [[] for _ in range(len(table))]
        for k in range(order + 1):
            names = [np.cumsum(_from_planes(x.as_py(), np.uint64, n[k], LOW), dtype=np.uint64) + first for x, n in zip(pc.list_element(table["names"], k), sizes)]
            counts = [_from_planes(x.as_py(), np.uint64, n[k]) for x, n in zip(pc.list_element(table["counts"], k), sizes)]
            for out, t in zip(totals, _added_up(names, counts)):
                out.append(_planes(t))
        return pa.Table.from_arrays([table["block"], table["part"], table["n"], pa.array(totals, pa.list_(pa.binary()))],
                                    names=["block", "part", "n", "totals"])

    def score(table, answers):
        import pyarrow as pa

        block, totals = Block(table["text"].to_pylist(), order), [[np.zeros(0, np.uint64)] for _ in range(order + 1)]
        for _, n, data in sorted(zip(*(answers[c].to_pylist() for c in ("part", "n", "totals")))):
            for k, x in enumerate(data):
                totals[k].append(_from_planes(x, np.uint64, n[k]))
        value, used = _scores(block, [np.concatenate(t) for t in totals], order)
        return pa.Table.from_arrays(
            [table["doc_id"], pa.array(block.sizes), pa.array(value / MICRO), pa.array(used.tolist(), pa.list_(pa.int64()))],
            names=["doc_id", "n_words", "log_score", "used"])

    asked = rows.groupBy("block").applyInArrow(ask, "part int, block int, n array<int>, names array<binary>, counts array<binary>")
    answers = asked.groupBy("part").applyInArrow(add_up, "block int, part int, n array<int>, totals array<binary>")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, n_words long, log_score double, used array<long>")


#: The scores of all documents for DuckDB, order 3.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT r, unnest(ws) AS w3, generate_subscripts(ws, 1) AS p FROM d),
g AS (SELECT r, p, w3, lag(w3, 1) OVER s AS w2, lag(w3, 2) OVER s AS w1 FROM t WINDOW s AS (PARTITION BY r ORDER BY p)),
n AS (SELECT sum(len(ws)) AS n FROM d),
c AS (
  SELECT g.*, len(d.ws) AS own,
    count(*) OVER (PARTITION BY w3) - count(*) OVER (PARTITION BY r, w3) AS c3,
    count(*) OVER (PARTITION BY w2, w3) - count(*) OVER (PARTITION BY r, w2, w3) AS c23,
    count(*) OVER (PARTITION BY w1, w2, w3) - count(*) OVER (PARTITION BY r, w1, w2, w3) AS c123
  FROM g JOIN d USING (r)),
x AS (
  SELECT r, p, own, CASE WHEN p >= 1 THEN c3 END AS c3, CASE WHEN p >= 2 THEN c23 END AS c23, CASE WHEN p >= 3 THEN c123 END AS c123,
    lag(c3) OVER s AS before1, lag(c23) OVER s AS before2, n.n - own AS words, least(p, 3) AS most
  FROM c, n WINDOW s AS (PARTITION BY r ORDER BY p)),
b AS (
  SELECT *, CASE WHEN c123 > 0 THEN 3 WHEN c23 > 0 THEN 2 WHEN c3 > 0 THEN 1 ELSE 0 END AS best,
    CASE WHEN c123 > 0 THEN c123 / CAST(before2 AS DOUBLE) WHEN c23 > 0 THEN c23 / CAST(before1 AS DOUBLE)
         WHEN c3 > 0 THEN c3 / CAST(words AS DOUBLE) ELSE 1.0::DOUBLE / (words + 1.0::DOUBLE) END AS ratio
  FROM x),
s AS (
  SELECT r, CAST(sum(CAST(round(1000000 * (ln(ratio) + (most - best) * ln(0.4::DOUBLE))) AS BIGINT)) AS BIGINT) AS v,
    count(*) FILTER (best = 3) AS trigrams, count(*) FILTER (best = 2) AS bigrams,
    count(*) FILTER (best = 1) AS unigrams, count(*) FILTER (best = 0) AS unseen
  FROM b GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(v, 0) / 1000000.0::DOUBLE AS log_score,
  CASE WHEN len(ws) > 0 THEN v / 1000000.0::DOUBLE / len(ws) END AS mean_log_score,
  coalesce(trigrams, 0) AS trigrams, coalesce(bigrams, 0) AS bigrams, coalesce(unigrams, 0) AS unigrams, coalesce(unseen, 0) AS unseen
FROM d LEFT JOIN s USING (r)
"""
