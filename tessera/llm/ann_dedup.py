"""Near-duplicate vectors by a robust-pruned flat graph.

1. Shards. Pivots, a bounded sample of about one vector in ``SHARD`` (at most
   ``PIVOTS`` of them), cut the unit sphere; every vector goes to the shards of
   its ``OVERLAP`` nearest pivots. Of pivots nearer to each other than ``APART``
   one stays, so that a large group of near copies isn't cut up. A shard larger than ``LARGEST`` is dealt by
   hash to sub-shards, and each pair of sub-shards is a task of its own, so no
   task is unbounded and no pair of a shard is lost.
2. Graph. A task links each of its vectors to its nearest ones and prunes them
   robustly: a neighbour goes if a kept one is nearer to it, by the factor
   ``ALPHA``, than the vector is. Links are kept in both directions.
3. Adjacency lists of a vector from all its tasks are united.
4. Search. In each task, over the united lists, a greedy search with beam
   ``BEAM`` runs from the medoid and the vector's own links towards it, then the
   range is expanded: neighbours of everything found within the threshold are
   visited until nothing new is within it.
5. Every link is verified: cosine in double precision. A pair that meets in
   several tasks is counted in one of them (that of the smallest common pivot).
   A task returns a count a vector and a star a component, not the pairs, so a
   group of near copies gives rows in proportion to its vectors. Counts are
   summed, and the stars united by distributed connected components.
6. Recall is audited: a bounded sample of ``AUDIT`` vectors, whose links the
   tasks return as pairs, is compared with all rows in blocks; ``audit`` gives
   found and true links.

Exact copies are one node with a count, so a large group of copies costs one
vector. Edge cases: vectors that are null, empty, zero or hold null or
non-finite components link with nothing and keep their own id; vectors of
different lengths don't link; rows repeating a ``vec_id`` are one vector (the
least, usable ones first); a null id is left out; extra columns are ignored;
an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, materialise, ship_code
from tessera.llm.va_search import usable

SHARD, PIVOTS, OVERLAP, LARGEST = 1000, 4096, 2, 2000
DEGREE, NEAREST, ALPHA, BEAM = 24, 64, 1.2, 24
AUDIT = 64
#: Vector lengths that get pivots, the most frequent ones.
LENGTHS = 64
#: Cosine at twice the angle of 0.95: two vectors linked to a third are at least as near.
APART = 2 * 0.95 ** 2 - 1


def unit_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of doubles, null if it links with nothing): one row an id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null")
    good = usable(F.col("v")) & F.exists("v", lambda x: x != 0.0)
    return rows.select("vec_id", F.when(good, F.col("v")).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column) -> np.ndarray:
    n = len(column)
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _normed(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow of the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pruned_graph(x: np.ndarray, degree: int = DEGREE, nearest: int = NEAREST, alpha: float = ALPHA) -> list[np.ndarray]:
    """Robust-pruned neighbours of each row of unit vectors."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    out = []
    m = min(nearest, n - 1)
    for low in range(0, n, 512):
        sims = x[low:low + 512] @ x.T
        sims[np.arange(len(sims)), low + np.arange(len(sims))] = -2
        close = np.argpartition(-sims, m - 1, axis=1)[:, :m]
        close = np.take_along_axis(close, np.argsort(-np.take_along_axis(sims, close, 1), axis=1, kind="stable"), 1)
        for i, row in enumerate(close):
            own = 1 - sims[i, row]                          # squared distance / 2, rising
            among = 1 - x[row] @ x[row].T
            kept, open_ = [], np.ones(m, bool)
            for j in range(m):
                if open_[j]:
                    kept.append(j)
                    if len(kept) == degree:
                        break
                    open_ &= alpha * alpha * among[j] > own    # squared distances: alpha squared
            out.append(row[kept])
    return out


def _both_ways(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    a = np.repeat(np.arange(len(lists)), [len(r) for r in lists])
    b = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    pairs = np.unique(np.stack((np.concatenate((a, b)), np.concatenate((b, a))), 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def range_search(x: np.ndarray, start: np.ndarray, neighbours: np.ndarray, threshold: float, beam: int = BEAM) -> np.ndarray:
    """Square of truth: whether the searches reach j from i or i from j with a cosine >= threshold (nearly; to be verified).

    ``neighbours[start[i]:start[i + 1]]`` are the links of row i.
    """
    n = len(x)
    hit = np.zeros((n, n), bool)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    for q in range(n):
        sims, done, known = np.full(n, -2.0), np.zeros(n, bool), np.zeros(n, bool)
        seen = new = np.unique(np.append(neighbours[start[q]:start[q + 1]], medoid))
        while True:
            if len(new):
                known[new] = True
                sims[new] = x[new] @ x[q]
            # greedy: the best unexpanded of the beam; then everything within the range
            best = seen[np.argpartition(-sims[seen], beam - 1)[:beam]] if len(seen) > beam else seen
            todo = best[~done[best]]
            if len(todo) > 4:
                todo = todo[np.argpartition(-sims[todo], 3)[:4]]
            elif not len(todo):
                todo = seen[(sims[seen] >= threshold) & ~done[seen]]
                if not len(todo):
                    break
            done[todo] = True
            new = np.unique(np.concatenate([neighbours[start[v]:start[v + 1]] for v in todo]))
            new = new[~known[new]]
            seen = np.concatenate((seen, new))
        hit[q, seen[sims[seen] >= threshold - 1e-9]] = True
    hit |= hit.T
    np.fill_diagonal(hit, False)
    return hit


def verified(x: np.ndarray, hit: np.ndarray, threshold: float) -> np.ndarray:
    """Of the pairs, those whose cosine is at least the threshold, the same for either order."""
    out = np.zeros_like(hit)
    for low in range(0, len(x), 256):
        i, j = np.nonzero(hit[low:low + 256])
        for part in range(0, len(i), 65536):
            a, b = i[part:part + 65536] + low, j[part:part + 65536]
            first, second = np.minimum(a, b), np.maximum(a, b)
            good = (x[first] * x[second]).sum(axis=1) >= threshold
            out[a[good], b[good]] = True
    return out


def own_pairs(pivots: np.ndarray, sub: np.ndarray, pivot: int, i: int, j: int) -> np.ndarray:
    """Square of truth: whether the pair is counted in this task, of all in which it meets."""
    n = len(pivots)
    own = np.ones((n, n), bool)
    for c in range(pivots.shape[1]):                     # a smaller pivot that both have counts it
        for d in range(pivots.shape[1]):
            same = pivots[:, c, None] == pivots[None, :, d]
            own &= ~(same & (pivots[:, c, None] < pivot))
    if i != j:                                           # within a sub-shard: its task with the first other one
        other = np.where(sub == i, j, i)
        first = other == np.where(sub == 0, 1, 0)
        own &= (sub[:, None] != sub[None, :]) | first[:, None]
    return own


def least_reachable(hit: np.ndarray) -> np.ndarray:
    """Smallest row that each row reaches."""
    label = np.arange(len(hit))
    a, b = np.nonzero(hit)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def spread(x: np.ndarray, apart: float = APART) -> np.ndarray:
    """Of unit vectors, in order, those less near than ``apart`` to all that are kept before them."""
    kept = np.zeros(len(x), bool)
    for i in range(len(x)):
        kept[i] = not (x[:i][kept[:i]] @ x[i] >= apart).any()
    return x[kept]


def shards(nodes: DataFrame, shard: int = SHARD, pivots: int = PIVOTS, overlap: int = OVERLAP, largest: int = LARGEST) -> DataFrame:
    """``nodes(vec_id, v)``, with ``copies`` or one each, dealt to overlapping tasks: dim, pivot, i, j, sub, pivots, copies, vec_id, v.

    ``pivots`` are all those of the vector, ``sub`` is its sub-shard in this one.
    """
    spark = nodes.sparkSession
    ship_code(spark)
    copies = F.col("copies") if "copies" in nodes.columns else F.lit(1)
    nodes = nodes.select("vec_id", "v", copies.cast("long").alias("copies"), F.size("v").alias("dim"))
    # pivots for the most frequent lengths; a length without one is a shard of its own, dealt to sub-shards like any large one
    lengths = nodes.groupBy("dim").count()
    sizes = {r["dim"]: r["count"] for r in lengths.orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()}
    total = lengths.agg(F.sum("count")).first()[0] or 0
    want = min(pivots, -(-total // shard)) if total else 0
    share = min(1.0, 2 * want / max(total, 1))
    chosen = nodes.where(F.col("dim").isin(list(sizes)) & (F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)))).orderBy(F.xxhash64("vec_id")).limit(2 * pivots)
    rows = chosen.select("dim", "v").collect()
    by = {d: spread(_normed(np.array([r["v"] for r in rows if r["dim"] == d][:max(1, want * sizes[d] // total)]))) for d in {r["dim"] for r in rows}}
    sent = spark.sparkContext.broadcast(by)        # at most PIVOTS vectors

    def assign(batches):
        import pyarrow as pa

        for batch in batches:
            dims = np.asarray(batch.column(3))
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                base = sent.value.get(int(dim))
                if base is None:
                    near = np.zeros((len(rows), 1), np.int32)
                else:
                    sims = _normed(_matrix(rows.column(1))) @ base.T
                    k = min(overlap, sims.shape[1])
                    near = np.argpartition(-sims, k - 1, axis=1)[:, :k].astype(np.int32)
                every = pa.array(near.tolist(), pa.list_(pa.int32()))
                for c in range(near.shape[1]):
                    yield pa.RecordBatch.from_arrays([rows.column(3), pa.array(near[:, c], pa.int32()), every, rows.column(2), rows.column(0), rows.column(1)],
                                                     names=["dim", "pivot", "pivots", "copies", "vec_id", "v"])

    dealt = materialise(nodes.mapInArrow(assign, "dim int, pivot int, pivots array<int>, copies long, vec_id long, v array<double>"), "ann-shards")
    sizes = dealt.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / largest).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(own.alias("sub"), F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    # of a shard in one part the only pair is (0, 0); of more parts, pairs (i, i) lie within every pair of i
    return (dealt.join(sizes, ["dim", "pivot"]).withColumn("p", F.explode(pairs))
            .where("parts = 1 or p.i < p.j").select("dim", "pivot", "p.i", "p.j", "p.sub", "pivots", "copies", "vec_id", "v"))


def links(nodes: DataFrame, threshold: float, watch: tuple[int, ...] = ()) -> DataFrame:
    """What the tasks find between distinct vectors ``nodes(vec_id, v, copies)``: kind, a, b.

    ``count``: a has b links (copies counted) that belong to this task;
    ``star``: a reaches b; ``pair``: a link a < b with an end in ``watch``.
    """
    tasks = materialise(shards(nodes), "ann-tasks")
    key = ["dim", "pivot", "i", "j"]

    def build(table):
        import pyarrow as pa

        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids)
        a, b = _both_ways(pruned_graph(_normed(_matrix(table["v"]))[order]))
        return pa.Table.from_arrays([pa.array(ids[order][a]), pa.array(ids[order][b])], names=["a", "b"])

    def search(table, lists):
        import pyarrow as pa

        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids)
        ids, x = ids[order], _normed(_matrix(table["v"]))[order]
        a = lists["a"].to_numpy() if len(lists) else np.zeros(0, np.int64)
        b = lists["b"].to_numpy() if len(lists) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(ids, b), len(ids) - 1)
        here = ids[at] == b                                  # of the united lists, what lies in this task
        a, b = np.searchsorted(ids, a[here]), at[here]
        by = np.lexsort((b, a))
        start = np.searchsorted(a[by], np.arange(len(ids) + 1))
        hit = verified(x, range_search(x, start, b[by], threshold), threshold)
        pivots = _matrix(table["pivots"])[order]
        here = [table[c][0].as_py() for c in key[1:]]
        mine = hit & own_pairs(pivots, table["sub"].to_numpy()[order], *here)
        count = mine @ table["copies"].to_numpy()[order]
        label = least_reachable(hit)
        linked, below = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(ids)))
        seen = np.flatnonzero(np.isin(ids, watched.value))
        at, end = np.nonzero(hit[seen])
        low, high = np.minimum(ids[seen[at]], ids[end]), np.maximum(ids[seen[at]], ids[end])
        kinds = ["count"] * len(linked) + ["star"] * len(below) + ["pair"] * len(low)
        return pa.Table.from_arrays([pa.array(kinds, pa.string()), pa.array(np.concatenate((ids[linked], ids[below], low))),
                                     pa.array(np.concatenate((count[linked], ids[label[below]], high)))], names=["kind", "a", "b"])

    watched = nodes.sparkSession.sparkContext.broadcast(np.array(watch, np.int64))
    united = materialise(tasks.groupBy(*key).applyInArrow(build, "a long, b long").distinct(), "ann-lists")
    other = [f"{c}_of_a" for c in key]
    lists = tasks.select(*[F.col(c).alias(o) for c, o in zip(key, other)], F.col("vec_id").alias("a")).join(united, "a")
    found = tasks.groupBy(*key).cogroup(lists.groupBy(*other)).applyInArrow(search, "kind string, a long, b long")
    return materialise(found, "ann-links")


def audit(nodes: DataFrame, found: DataFrame, rows: list, threshold: float) -> tuple[int, int]:
    """(links found, true links) of the sampled ``rows`` against all, by brute force in blocks."""
    spark = nodes.sparkSession
    sent = spark.sparkContext.broadcast([(r["vec_id"], np.array(r["v"])) for r in rows])

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            ids, dims = batch.column(0).to_numpy(), np.asarray(batch.column(2))
            for dim in np.unique(dims):
                own = dims == dim
                x = _normed(_matrix(batch.column(1).filter(pa.array(own))))
                for name, v in sent.value:
                    if len(v) == dim:
                        near = ids[own][(x @ _normed(v[None])[0]) >= threshold]
                        near = near[near != name]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), name)), pa.array(near)], names=["q", "other"])

    true = nodes.select("vec_id", "v", F.size("v").alias("dim")).mapInArrow(compare, "q long, other long")
    true = true.select(F.least("q", "other").alias("a"), F.greatest("q", "other").alias("b")).distinct()
    r = true.join(found.withColumn("hit", F.lit(1)), ["a", "b"], "left").agg(F.count("hit"), F.count(F.lit(1))).first()
    return int(r[0]), int(r[1])


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                    audited: int = AUDIT) -> DataFrame:
    """vec_id, n_links, component_id, kept (and audit_found, audit_true) of every vector."""
    rows = materialise(unit_vectors(vectors, id_col, vector_col), "ann-vectors")
    # equal vectors are one node: the least id stands for them
    nodes = materialise(rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")), "ann-nodes")
    sample = nodes.orderBy(F.xxhash64(F.lit(3), "vec_id")).limit(audited).collect()
    found = links(nodes, threshold, tuple(r["vec_id"] for r in sample))
    hits, true = audit(nodes, found.where("kind = 'pair'").select("a", "b").distinct(), sample, threshold)
    counted = found.where("kind = 'count'").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))
    label = connected_components(found.where("kind = 'star'"))
    node = (nodes.join(counted, nodes["vec_id"] == counted["node"], "left").drop("node")
            .join(label, F.col("vec_id") == F.col("node"), "left")
            .select("v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "vec_id").alias("component_id")))
    return rows.join(node, "v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"), F.lit(hits).cast("long").alias("audit_found"), F.lit(true).cast("long").alias("audit_true"))
