"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 32 two-bit segments. One
differing bit changes one count by one, so the Manhattan distance of two
embeddings never exceeds the Hamming distance: fingerprints within ``BITS``
bits lie within Manhattan distance ``BITS``. The 32 coordinates are split into
``GROUPS`` groups; at distance 3 or less, at least ``GROUPS - 3`` groups agree
in every count. So each choice of ``GROUPS - 3`` groups is a grid over its
coordinates, and every link shares a cell of one of the grids. Candidates of a
cell pass the Manhattan bound, then the exact bit distance.

Only distinct fingerprints are joined (copies share one); cells of one
fingerprint are dropped before the join; a cell of more than ``CELL``
fingerprints is dealt to block pairs of bounded size, so nothing is capped and
no task gets an unbounded cell. A cell gives back a spanning tree of its
links, not all pairs, and the trees are merged by distributed connected
components.

Edge cases: null, empty and blank texts have fingerprint zero and link like
any other; a long text's hashes are counted 8,192 at a time; repeated rows are
alike; a row with a null ``doc_id`` links, but is
nobody's ``component_id`` (null if all its component's ids are null); extra
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, materialise, partitions, ship_code, spread_join

SHINGLE, BITS, GROUPS, CELL = 3, 3, 6, 1000
SEED = 42
_LOW = 0x5555555555555555


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased (A-Z) ASCII-space-separated word shingles, XXH64, as a signed long."""
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
        starts = [0, *(e + 1 for e in ends)]
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])]
    counts = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 8192):
        h = np.array(hashes[low:low + 8192], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` and ``fp`` (long) of every row of ``docs(text, ...)``."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = [fingerprint(t, shingle) for low in range(0, len(texts), 512) for t in texts.slice(low, 512).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps, pa.int64())], names=[*keep, "fp"])

    ship_code(docs.sparkSession)
    rows = docs.select(*keep, F.col("text").cast("string").cast("binary").alias("text"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "fp long"]))


def embedding(fp: Column) -> Column:
    """The 32 segment bit counts, two bits each, in one long."""
    # 00, 01, 10, 11 to counts 0, 1, 1, 2: the high bit is set where both are, the low bit where one is
    low, high = fp.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def grids(bits: int = BITS, groups: int = GROUPS) -> list[int]:
    """A mask of embedding coordinates for each choice of groups - bits groups (as signed longs)."""
    if not 0 <= bits < groups <= 32:
        raise ValueError("needs 0 <= bits < groups <= 32")
    own = [sum(3 << (2 * s) for s in range(32) if s % groups == g) for g in range(groups)]
    masks = [sum(own[g] for g in some) for some in combinations(range(groups), groups - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of two-bit counts (0 to 2) packed into unsigned longs."""
    x = a ^ b
    low, high = x & np.uint64(_LOW), (x >> np.uint64(1)) & np.uint64(_LOW)
    return np.bitwise_count(low) + 2 * np.bitwise_count(high) - 2 * np.bitwise_count(low & high)


def _cell_links(fps: np.ndarray, bits: int):
    """Spanning links of one cell: (index, index of the first fingerprint of its part)."""
    e = fps - ((fps >> np.uint64(1)) & np.uint64(_LOW))
    near = manhattan(e[:, None], e[None, :]) <= bits
    i, j = np.nonzero(near)
    keep = (i != j) & (np.bitwise_count(fps[i] ^ fps[j]) <= bits)
    i, j = i[keep], j[keep]
    label = np.arange(len(fps))
    while len(i):
        new = label.copy()
        np.minimum.at(new, i, label[j])
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(fps)))
    return own, label[own]


def links(distinct: DataFrame, bits: int = BITS, groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """Links ``a, b`` that connect exactly the ``fp`` of ``distinct`` that chains of ``bits`` or fewer differing bits connect."""
    spark = distinct.sparkSession
    n = partitions(spark)
    e = embedding(F.col("fp"))
    spots = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("grid"), e.bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(grids(bits, groups))])).alias("x")
    ).select("fp", "x.grid", "x.cell")
    shared = materialise(spots.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-cells")
    blocks = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    dealt = (spots.join(shared, ["grid", "cell"])
             .select("grid", "cell", "fp", F.explode(pairs).alias("p")).select("grid", "cell", "p.i", "p.j", "fp")
             .repartition(n, "grid", "cell", "i", "j").sortWithinPartitions("grid", "cell", "i", "j"))

    def verify(batches):
        import pyarrow as pa

        held = [np.zeros(0, np.int64)] * 5

        def found(columns):
            """Links of whole cells; a fingerprint occurs once in each."""
            change = np.zeros(len(columns[0]), bool)
            for c in columns[:4]:
                change[1:] |= c[1:] != c[:-1]
            bounds = [0, *np.flatnonzero(change).tolist(), len(change)]
            fps, a, b = columns[4].view(np.uint64), [], []
            for low, high in zip(bounds, bounds[1:]):
                if high - low > 1:
                    i, j = _cell_links(fps[low:high], bits)
                    a.append(i + low)
                    b.append(j + low)
            if a:
                a, b = (columns[4][np.concatenate(x)] for x in (a, b))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            last = np.ones(len(held[0]), bool)
            for c in held[:4]:
                last &= c == c[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            yield from found([c[:cut] for c in held])
            held = [c[cut:] for c in held]
        yield from found(held)

    ship_code(spark)
    return dealt.mapInArrow(verify, "a long, b long")


def components(rows: DataFrame, bits: int = BITS, groups: int = GROUPS, cell: int = CELL) -> DataFrame:
    """``rows(doc_id, fp, ...)``, a written table, with ``component_id``, the smallest doc_id reachable by links, and ``component_fp``,
    the smallest fp, which names the component also where no doc_id does."""
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    label = materialise(connected_components(links(distinct, bits, groups, cell)), "simhash-labels")
    member = label.join(distinct, label["node"] == distinct["fp"]).select("fp", "label", "least")
    merged = member.join(member.groupBy("label").agg(F.min("least").alias("merged")), "label").select("fp", "label", "merged")
    final = distinct.join(merged, "fp", "left").select("fp", F.coalesce("merged", "least").alias("component_id"),
                                                       F.coalesce("label", "fp").alias("component_fp"))
    return spread_join(rows, materialise(final, "simhash-components"), "fp")


def near_duplicates(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), shingle: int = SHINGLE, bits: int = BITS, named: bool = False) -> DataFrame:
    """Columns ``keep`` (with doc_id), ``fingerprint`` (16 hex digits) and ``component_id`` of every row, if ``named`` also ``component_fp``."""
    rows = materialise(fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("long")), keep, shingle), "simhash-fingerprints")
    return components(rows, bits).select(*keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *["component_fp"] * named)
