"""Exact top-k inner product search with vector-approximation (VA) files.

The candidates are dealt to blocks of about ``ROWS`` vectors, written as two files.
The approximation of a block has one cell number of ``CELL_BITS`` bits a component
(equal-width cells between the block's extremes) and the ends of its cells; the
other file has the exact vectors. A search goes in two phases:

1. Only approximations are read. Each block of queries scans each block's cells:
   the cell bounds give every candidate a lower and an upper bound of its inner
   product. A block answers a query with its k greatest lower bounds and its greatest
   upper bound; the k-th greatest lower bound of all blocks is the query's limit.
2. Blocks whose greatest upper bound is below the limits of all queries are done. Of the
   others the exact vectors of candidates at or above the limit are read, in the order of
   their upper bounds and in growing steps, until the k-th best exact score of the block
   is above every bound not read.

The blocks' k best are merged by query in two levels. Every block's cells meet every
query block once (a stated query set against all rows); no other pairs are formed.

Components x become floor(scale * x); bounds and scores are whole numbers, exact
below 2^53 (beyond that bounds get room, and scores are computed with Python integers).

Edge cases: vectors that are null, empty or hold null or non-finite components
take no part, nor do null ids; only vectors of equal length are compared; of
several rows with one ``vec_id`` the least vector counts; equal scores go to
the smaller id; a query with fewer than k candidates returns all; extra columns
are ignored; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship_code

ROWS, QUERY_ROWS, CELL_BITS = 8192, 512, 4
#: Exact vectors read at first for a query in a block, and queries whose bounds are held at a time.
STEP, SCANNED = 16, 128
MERGE = 64      # blocks merged at once


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (array of doubles): one usable vector an id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).groupBy("vec_id").agg(F.min("v").alias("v"))


def packed(rows: DataFrame, name: str, size: int) -> DataFrame:
    """Blocks of about ``size`` rows ``vec_id, v`` of one dimension: dim, {name}, ids, data (packed arrays)."""
    def pack(table):
        import pyarrow as pa

        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids)
        v = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
        return pa.Table.from_arrays(
            [table["dim"][:1], table["block"][:1], pa.array([ids[order].astype("<i8").tobytes()]), pa.array([v.astype("<f8").tobytes()])],
            names=["dim", name, "ids", "data"])

    ship_code(rows.sparkSession)
    rows = rows.withColumn("dim", F.size("v"))
    count = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks"))    # a row a dimension
    return (rows.join(count, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).drop("blocks")
            .groupBy("dim", "block").applyInArrow(pack, f"dim int, {name} int, ids binary, data binary"))


def approximation(exact: np.ndarray, bits: int = CELL_BITS):
    """(cells, lower ends, upper ends): the cell number of each component and the ends of each dimension's cells."""
    cells = 1 << bits
    low, high = exact.min(axis=0), exact.max(axis=0)
    width = np.maximum((high - low) / cells, 1e-300)
    number = np.clip(((exact - low) / width).astype(np.int64), 0, cells - 1).astype(np.uint8)
    lower = np.empty((cells, exact.shape[1]))
    upper = np.empty_like(lower)
    for c in range(cells):                      # the true extremes of the cell: no rounding can break a bound
        here = number == c
        lower[c] = np.where(here, exact, np.inf).min(axis=0)
        upper[c] = np.where(here, exact, -np.inf).max(axis=0)
    return number, lower, upper


def cells_of(exact: np.ndarray, bits: int = CELL_BITS) -> tuple[bytes, bytes]:
    """The stored approximation of a block: cell numbers, two a byte where they fit, and the ends of all cells."""
    number, lower, upper = approximation(exact, bits)
    flat = number.ravel()
    if bits <= 4:
        flat = np.append(flat, np.uint8(0)) if len(flat) % 2 else flat
        flat = flat[::2] << 4 | flat[1::2]
    return flat.tobytes(), np.stack((lower, upper)).astype("<f8").tobytes()


def bounds_of(cells: bytes, ends: bytes, n: int, dim: int, bits: int = CELL_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper end of every component of a block's ``n`` vectors."""
    flat = np.frombuffer(cells, np.uint8)
    if bits <= 4:
        flat = np.stack((flat >> 4, flat & 15), 1).ravel()
    number = flat[:n * dim].reshape(n, dim)
    lower, upper = np.frombuffer(ends, "<f8").reshape(2, 1 << bits, dim)
    dims = np.arange(dim)
    return lower[number, dims], upper[number, dims]


def bounds(queries: np.ndarray, query_ids: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray):
    """For some queries at a time: their place, and lower and upper bounds of their inner products with a block's
    vectors (-inf for a query's own vector)."""
    room = 0.0
    if np.abs(queries).max(initial=0) * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)) * low.shape[1] >= 2 ** 53:
        room = 1e-9                                  # inexact sums: bounds get room
    for a in range(0, len(queries), SCANNED):
        part = slice(a, a + SCANNED)
        plus, minus = np.maximum(queries[part], 0), np.minimum(queries[part], 0)
        most, least = plus @ high.T + minus @ low.T, plus @ low.T + minus @ high.T
        if room:
            most, least = most + np.abs(most) * room + 1, least - np.abs(least) * room - 1
        own = query_ids[part, None] == ids[None, :]
        most[own] = least[own] = -np.inf
        yield a, least, most


def scan_block(queries: np.ndarray, query_ids: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, k: int):
    """A block's answer to each query: the greatest lower bounds (rows of at most k) and the greatest upper bound."""
    lows, tops = [], []
    for _, least, most in bounds(queries, query_ids, low, high, ids):
        n = least.shape[1]
        lows.append(np.partition(least, n - k, axis=1)[:, n - k:] if n > k else least)
        tops.append(most.max(axis=1))
    return np.concatenate(lows), np.concatenate(tops)


def settle(query: np.ndarray, exact: np.ndarray, ids: np.ndarray, at: np.ndarray, most: np.ndarray, k: int) -> tuple[list, int]:
    """The k best ``(score, id)`` of a block's candidates ``at`` for a query, and how many exact vectors were read:
    in the order of upper bounds ``most``, until nothing that is left can reach the k-th score."""
    order = np.argsort(-most, kind="stable")
    large = np.abs(query).max(initial=0) * np.abs(exact).max(initial=0) * exact.shape[1] >= 2 ** 53
    whole = [int(x) for x in query] if large else None
    found, low, step = [], 0, max(k, STEP)
    while low < len(order):
        some = order[low:low + step]
        if len(found) >= k and sorted((s for s, _ in found), reverse=True)[k - 1] > most[some[0]]:
            break
        rows = exact[at[some]]
        scores = [sum(a * int(b) for a, b in zip(whole, row)) for row in rows] if large else (rows @ query).astype(np.int64).tolist()
        found += zip(scores, ids[at[some]].tolist())
        low, step = low + step, 2 * step
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k], len(found)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
          rows: int = ROWS, query_rows: int = QUERY_ROWS, counts: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score of the k candidates of highest integer inner product for each query; with ``counts``
    also ``exact_read``, the exact vectors that the query read in all blocks."""
    def whole(df):
        return df.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("v"))

    blocks = materialise(packed(whole(clean(vectors, id_col, vector_col)), "block", rows), "va-exact")
    asked = materialise(packed(whole(clean(queries, id_col, vector_col)), "query_block", query_rows)
                        .withColumnRenamed("ids", "query_ids").withColumnRenamed("data", "query_data"), "va-queries")

    def approximate(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                dim, data = one.column("dim")[0].as_py(), one.column("data")[0].as_py()
                cells, ends = cells_of(np.frombuffer(data, "<f8").reshape(-1, dim))
                yield pa.RecordBatch.from_arrays([one.column("dim"), one.column("block"), one.column("ids"), pa.array([cells], pa.binary()), pa.array([ends], pa.binary())],
                                                 names=["dim", "block", "ids", "cells", "ends"])

    files = materialise(blocks.mapInArrow(approximate, "dim int, block int, ids binary, cells binary, ends binary"), "va-approximations")
    # a block's cells go to each query block of its dimension; a query block is read by key
    pairs = files.join(asked.select("dim", "query_block"), "dim").join(asked, ["dim", "query_block"])

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            for j in range(batch.num_rows):
                dim, block, query_block, ids, cells, ends, qids, qdata = (batch.column(c)[j].as_py() for c in (
                    "dim", "block", "query_block", "ids", "cells", "ends", "query_ids", "query_data"))
                ids, qids = np.frombuffer(ids, "<i8"), np.frombuffer(qids, "<i8")
                low, high = bounds_of(cells, ends, len(ids), dim)
                lows, tops = scan_block(np.frombuffer(qdata, "<f8").reshape(-1, dim), qids, low, high, ids, k)
                n = len(qids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, block, np.int32)), pa.array(np.full(n, query_block, np.int32)),
                     pa.array(np.arange(n, dtype=np.int32)), pa.array(qids), pa.array([x[x > -np.inf] for x in lows], pa.list_(pa.float64())), pa.array(tops)],
                    names=["dim", "block", "query_block", "q", "query_id", "lows", "top"])

    scanned = materialise(pairs.select("dim", "block", "query_block", "ids", "cells", "ends", "query_ids", "query_data").mapInArrow(
        scan, "dim int, block int, query_block int, q int, query_id long, lows array<double>, top double"), "va-scanned")

    # a query's limit, the k-th greatest lower bound of all blocks, in two levels: a group holds at most k of each part
    def greatest(df, *keys):
        return df.groupBy(*keys).agg(F.slice(F.sort_array(F.flatten(F.collect_list("lows")), asc=False), 1, k).alias("lows"))

    limit = greatest(greatest(scanned.withColumn("part", F.floor(F.col("block") / MERGE)), "query_id", "part"), "query_id").select(
        "query_id", F.when(F.size("lows") >= k, F.element_at("lows", -1)).otherwise(float("-inf")).alias("limit"))
    left = scanned.join(limit, "query_id").where((F.col("top") >= F.col("limit")) & (F.col("top") > float("-inf")))
    # blocks that may hold a result meet their exact vectors and the queries that are still open
    wanted = left.groupBy("dim", "block", "query_block").agg(F.collect_list(F.struct("q", "limit")).alias("open"))
    exact = wanted.join(blocks, ["dim", "block"]).join(files.select("dim", "block", "cells", "ends"), ["dim", "block"]).join(asked, ["dim", "query_block"])

    def best(df, *keys):
        top = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
        return df.groupBy(*keys).agg(top.alias("top"))

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for j in range(batch.num_rows):
                dim, block, ids, data, cells, ends, qids, qdata = (batch.column(c)[j].as_py() for c in (
                    "dim", "block", "ids", "data", "cells", "ends", "query_ids", "query_data"))
                held = batch.column("open")[j].values
                order = np.argsort(held.field(0).to_numpy(zero_copy_only=False))
                q, limits = (held.field(n).to_numpy(zero_copy_only=False)[order] for n in range(2))
                ids, names = np.frombuffer(ids, "<i8"), np.frombuffer(qids, "<i8")[q]
                vectors, asking = np.frombuffer(data, "<f8").reshape(-1, dim), np.frombuffer(qdata, "<f8").reshape(-1, dim)[q]
                low, high = bounds_of(cells, ends, len(ids), dim)
                out = []
                for a, _, most in bounds(asking, names, low, high, ids):
                    for b, upper in enumerate(most, a):
                        at = np.flatnonzero((upper >= limits[b]) & (upper > -np.inf))
                        if len(at):
                            found, n = settle(asking[b], vectors, ids, at, upper[at], k)
                            out += [(int(names[b]), x, s, n if place == 0 else 0) for place, (s, x) in enumerate(found)]
                if out:
                    of, others, scores, reads = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array([block // MERGE] * len(out), pa.int32()), pa.array(others, pa.int64()),
                                                      pa.array(scores, pa.int64()), pa.array(reads, pa.int64())], names=["query_id", "part", "vec_id", "score", "n_read"])

    found = exact.select("dim", "block", "ids", "data", "cells", "ends", "query_ids", "query_data", "open").mapInArrow(
        read, "query_id long, part int, vec_id long, score long, n_read long")
    found = materialise(found, "va-scores") if counts else found
    # first the k best of each MERGE blocks, then of all: a group holds at most k rows of each part
    first = best(found, "query_id", "part").select("query_id", F.explode("top").alias("x")).select("query_id", "x.vec_id", (-F.col("x.s")).alias("score"))
    out = best(first, "query_id").select("query_id", F.posexplode("top").alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score"))
    return out.join(found.groupBy("query_id").agg(F.sum("n_read").alias("exact_read")), "query_id") if counts else out
