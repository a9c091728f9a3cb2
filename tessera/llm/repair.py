"""Token ids as a binary file format compressed by Re-Pair grammars.

Documents are range-partitioned and sorted by ``doc_id`` (nulls first; ties by
a hash of the text), encoded, and cut into shards of about ``shard_tokens``
ids. Each shard is compressed by Re-Pair: round by round, all frequent adjacent id
pairs inside a document are replaced by new nonterminals, occurrences that overlap
taken from the left (a run of equal ids halves each round), until no pair is frequent. A shard blob holds the rules,
their expansion lengths, the documents' places and the symbols, so that one
document, or one id of it, is decoded without touching the rest.

Container: Parquet with a row a shard (``part, shard, part_start, n_ids,
blob``), because Spark's writers reach every store and commit atomically.

Edge cases: a null or empty text holds only the end id; repeated rows are
documents of their own; extra columns are ignored; an empty table gives an
empty file set. A task holds one shard and one Arrow batch of texts.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, ship_code

MAGIC = b"TRP1"
SHARD_TOKENS = 4_000_000
#: Least count of a pair that gets a rule, and least number of its replacements: a rule costs two symbols and a length.
LEAST, USEFUL = 8, 4
_NONE = np.iinfo(np.int32).max
_ODD, _TABLE = np.uint64(0x9E3779B97F4A7C15), 20
#: Pairs from which a round is worth a hash table.
_MANY = 1 << 17


def chosen_places(at: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which of the pairs at ascending places ``at`` are replaced together, so that none overlap: those of smaller
    ``order`` than the pairs they overlap; of the rest, in each chain of overlapping pairs, every second from the left."""
    linked = np.zeros(len(at) + 1, bool)
    linked[1:-1] = at[1:] == at[:-1] + 1
    if not linked.any():
        return np.ones(len(at), bool)
    take = np.ones(len(at), bool)
    take[1:] &= ~linked[1:-1] | (order[1:] < order[:-1])
    take[:-1] &= ~linked[1:-1] | (order[:-1] <= order[1:])
    free = ~take
    free[1:] &= ~(linked[1:-1] & take[:-1])
    free[:-1] &= ~(linked[1:-1] & take[1:])
    rest = np.flatnonzero(free)
    if len(rest):
        first = np.concatenate(([True], (rest[1:] != rest[:-1] + 1) | ~linked[rest[1:]]))
        place = np.arange(len(rest)) - np.maximum.accumulate(np.where(first, np.arange(len(rest)), 0))
        take[rest[place % 2 == 0]] = True
    return take


def _ranked(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that stand ``least`` times or more, the most frequent first, and for each place the rank of its pair
    (``_NONE`` for rare ones; among many, that of a frequent pair of the same hash)."""
    if len(pairs) < _MANY:
        own, of, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        frequent = np.flatnonzero(counts >= least)
        frequent = frequent[np.argsort(-counts[frequent], kind="stable")]
        rank = np.full(len(own) + 1, _NONE, np.int32)
        rank[frequent] = np.arange(len(frequent), dtype=np.int32)
        return own[frequent], rank[of]
    spot = ((pairs * _ODD) >> np.uint64(64 - _TABLE)).astype(np.int32)      # hash of each pair
    ordered = np.sort(pairs)        # no slower than leaving out first what is rare by its hash
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    frequent = np.flatnonzero(counts >= least)
    frequent = frequent[np.argsort(-counts[frequent], kind="stable")]
    chosen = ordered[starts[frequent]]
    place = ((chosen * _ODD) >> np.uint64(64 - _TABLE)).astype(np.int64)
    rank = np.full(1 << _TABLE, _NONE, np.int32)
    rank[place[::-1]] = np.arange(len(chosen) - 1, -1, -1, dtype=np.int32)
    return chosen, rank.take(spot)


def compress(ids: np.ndarray, ends: np.ndarray, least: int = LEAST):
    """Re-Pair of ``ids`` (uint32); ``ends`` marks each document's last id.

    Every round gives a rule to each pair that stands ``least`` times or more within documents and
    replaces its occurrences, until no pair does. A pair that was too rare stays too rare, so a
    round looks only at pairs beside replaced symbols and at those that had to wait.

    Returns (symbols, ends, rules, first): rules[i] is the pair that symbol
    ``first + i`` stands for; its parts are ids or earlier nonterminals.
    """
    symbols, ends = ids.astype(np.uint32), ends.astype(bool)
    first = int(symbols.max()) + 1 if len(symbols) else 0
    rules, n_rules = [np.zeros((0, 2), np.uint32)], 0
    fresh = np.ones(len(symbols), bool)
    while len(symbols) > 1:
        # places are taken by index: numpy picks by a mask several times slower
        at = np.flatnonzero((fresh[:-1] | fresh[1:]) & ~ends[:-1])
        pairs = symbols.take(at).astype(np.uint64)
        pairs <<= np.uint64(32)
        pairs |= symbols[1:].take(at)
        chosen, order = _ranked(pairs, least)
        hit = np.flatnonzero(order != _NONE)
        waiting, order = at.take(hit), order.take(hit)          # taken, in the way of another, or behind another of their hash
        if len(hit):
            own = np.flatnonzero(chosen.take(order) == pairs.take(hit))
            where, order = waiting.take(own), order.take(own)
            take = np.flatnonzero(chosen_places(where, order))
            where, order = where.take(take), order.take(take)
            useful = np.bincount(order, minlength=len(chosen)) >= USEFUL
            if not useful.all():
                take = np.flatnonzero(useful.take(order))
                where, order = where.take(take), order.take(take)
        else:
            where = waiting
        if not len(where):
            break
        name = first + n_rules + np.cumsum(useful) - 1
        new = chosen[useful]
        rules.append(np.stack((new >> np.uint64(32), new & np.uint64(0xFFFFFFFF)), 1).astype(np.uint32))
        n_rules += len(new)
        fresh[:] = False
        fresh[waiting] = True
        fresh[where] = True
        symbols[where] = name.take(order)
        ends[where] = ends[1:].take(where)
        keep = np.ones(len(symbols), bool)
        keep[1:][where] = False
        keep = np.flatnonzero(keep)
        symbols, ends, fresh = symbols.take(keep), ends.take(keep), fresh.take(keep)
    return symbols, ends, np.concatenate(rules), first


def by_level(rules: np.ndarray, first: int) -> list[np.ndarray]:
    """Rules in groups, each of which refers to ids and rules of the groups before it only."""
    parts = rules.astype(np.int64) - first
    level = np.zeros(len(rules), np.int64)
    while True:
        below = np.where(parts >= 0, level[np.maximum(parts, 0)] + 1, 0).max(axis=1, initial=0)
        if (below == level).all():
            break
        level = below
    order = np.argsort(level, kind="stable")
    return [g for g in np.split(order, np.flatnonzero(np.diff(level[order])) + 1) if len(g)]


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Number of ids each rule stands for."""
    lengths = np.ones(len(rules), np.int64)
    parts = rules.astype(np.int64) - first
    for group in by_level(rules, first):
        lengths[group] = np.where(parts[group] >= 0, lengths[np.maximum(parts[group], 0)], 1).sum(axis=1)
    return lengths


def pack(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard's blob. ``lengths``: ids of each document (1 or more)."""
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(lengths) - 1] = True
    symbols, ends, rules, first = compress(ids, ends)
    places = np.concatenate(([0], np.flatnonzero(ends) + 1))
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], "u1")
    return b"".join((MAGIC, struct.pack("<4q", len(names), len(rules), len(symbols), first),
                     rules.astype("<u4").tobytes(), expansion_lengths(rules, first).astype("<u8").tobytes(),
                     names.tobytes(), nulls.tobytes(), places.astype("<u8").tobytes(), symbols.astype("<u4").tobytes()))


class Shard:
    """Random access to a shard blob."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a token shard")
        docs, rules, symbols, self.first = struct.unpack_from("<4q", blob, 4)
        at = 36

        def read(kind, n):
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        self.rules = read("<u4", 2 * rules).reshape(-1, 2)
        self.rule_lengths = read("<u8", rules).astype(np.int64)
        self.names, self.nulls = read("<i8", docs), read("u1", docs)
        self.places = read("<u8", docs + 1).astype(np.int64)
        self.symbols = read("<u4", symbols)
        self._flat = None

    def __len__(self) -> int:
        return len(self.names)

    def doc_id(self, i: int):
        return None if self.nulls[i] else int(self.names[i])

    def _expansions(self):
        """All rules written out, one after the other, with their places."""
        if self._flat is None:
            places = np.concatenate(([0], np.cumsum(self.rule_lengths)))
            flat = np.empty(places[-1], np.uint32)
            for group in by_level(self.rules, self.first):
                at = places[group]
                for part in self.rules[group].T:
                    own = part < self.first
                    flat[at[own]] = part[own]
                    rule = part[~own].astype(np.int64) - self.first
                    n = self.rule_lengths[rule]
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    flat[np.repeat(at[~own], n) + step] = flat[np.repeat(places[rule], n) + step]
                    at = at + self.lengths(part)
            self._flat = flat, places
        return self._flat

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.first
        out[rule] = self.rule_lengths[symbols[rule] - self.first]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, places = self._expansions()
        pool = np.concatenate((flat, symbols))       # ids stand for themselves
        start = len(flat) + np.arange(len(symbols))
        rule = symbols >= self.first
        start[rule] = places[symbols[rule] - self.first]
        n = self.lengths(symbols)
        shift = np.repeat(start - (np.cumsum(n) - n), n)
        return pool[shift + np.arange(len(shift))]

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.places[i]:self.places[i + 1]])

    def token(self, i: int, k: int) -> int:
        """Id ``k`` of document ``i``: down the one rule that covers it."""
        part = self.symbols[self.places[i]:self.places[i + 1]]
        ends = np.cumsum(self.lengths(part))
        j = int(np.searchsorted(ends, k, side="right"))
        x, k = int(part[j]), k - int(ends[j - 1] if j else 0)
        while x >= self.first:
            a, b = self.rules[x - self.first].tolist()
            n = 1 if a < self.first else int(self.rule_lengths[a - self.first])
            x, k = (a, k) if k < n else (b, k - n)
        return x


SHARD_SCHEMA = "part int, shard int, part_start long, n_ids long, blob binary"
TOKENS_SCHEMA = "part int, part_start long, doc_id long, n_tokens long, ids binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaces: bool = False,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs(doc_id, text)`` and write the shards in ascending doc_id order."""
    def shards(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tessera.llm.tokens import ROOMY, encoder, slabs

        enc, part, end = encoder(tokenizer, spaces, ROOMY), TaskContext.get().partitionId(), struct.pack("<I", end_id)
        names, parts, held, shard, start = [], [], 0, 0, 0

        def flush():
            lengths = np.array([len(p) // 4 for p in parts], np.int64)
            row = (part, shard, start, held, pack(names, lengths, np.frombuffer(b"".join(parts), "<u4")))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                                              names=["part", "shard", "part_start", "n_ids", "blob"])

        for batch in batches:
            for some in slabs(batch, 1):
                for name, ids in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    names.append(name)
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= shard_tokens:
                        yield flush()
                        names, parts, shard, start, held = [], [], shard + 1, start + held, 0
        if names:
            yield flush()

    spark = docs.sparkSession
    ship_code(spark)
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
     .repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text"))
     .sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(shards, SHARD_SCHEMA)
     .write.option("compression", "zstd").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All documents of the files: ``doc_id, start, n_tokens, ids`` (start: ids of all documents before it)."""
    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            for part, start, blob in zip(*(batch.column(n).to_pylist() for n in ("part", "part_start", "blob"))):
                shard = Shard(blob)
                for low in range(0, len(shard), 2000):      # bounded output batches
                    some = range(low, min(low + 2000, len(shard)))
                    a, b = shard.places[some.start], shard.places[some.stop]
                    n = np.add.reduceat(shard.lengths(shard.symbols[a:b]), shard.places[some.start:some.stop] - a)
                    data = shard.expand(shard.symbols[a:b]).astype("<u4").tobytes()
                    ends = np.cumsum(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(some), pa.int32()), pa.array(start + ends - n, pa.int64()),
                         pa.array([shard.doc_id(i) for i in some], pa.int64()), pa.array(n, pa.int64()),
                         pa.array([data[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), n.tolist())], pa.binary())],
                        names=["part", "part_start", "doc_id", "n_tokens", "ids"])
                    start += int(ends[-1])

    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # one row a partition of the writer: small by construction
    before = (files.groupBy("part").agg(F.sum("n_ids").alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
              .select("part", "before"))
    return (files.select("part", "part_start", "blob").mapInArrow(decode, TOKENS_SCHEMA)
            .join(F.broadcast(before), "part")
            .select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids"))


