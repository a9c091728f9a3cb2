"""Order-preserving sequence packing by dynamic programming.

The documents of a range partition, in ``doc_id`` order, form one stream of
token ids. Window cuts may fall at document ends (free), sentence ends (a small
penalty) and, inside sentences longer than ``GRID`` tokens, at a grid of hard
positions (a larger penalty). With ``f[j]`` the least cost of a packing that
cuts at position ``p[j]``:

    f[j] = penalty[j] + 1 + min( min f[i] + p[i] - p[j] + size,  f[i] where p[j] - p[i] is a power of two )

over ``p[j] - p[i] <= size``. The first term is a sliding-window minimum of
``f[i] + p[i]``, kept in a monotone queue, so a transition costs amortised
constant time; sequences whose length is a power of two need no padding. The 1
is the price of a sequence, so that equal paddings give fewer sequences.

The stream is cut into blocks of about ``BLOCK`` tokens at document ends (a
block ends a sequence), which bounds a task's memory by one block and one
document. Edge cases: null and empty texts hold only the end id; repeated rows
are documents of their own, ordered by a hash of the text; a null ``doc_id``
stays null; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import struct
from collections import deque

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, ship_code

SIZE = 1024
SENTENCE, HARD = 6, 40          # truncation penalties, in tokens of padding
GRID, STEP = 128, 32            # a stretch without boundary longer than GRID gets hard positions each STEP
BLOCK = 1_000_000

PIECE_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
                "offset long, ids binary")


def cut_positions(ends: np.ndarray, sentences: np.ndarray, total: int, size: int = SIZE):
    """Sorted candidate cuts and their penalties. ``ends``: document ends; both exclude 0."""
    p = np.unique(np.concatenate(([0], ends, sentences, [total])).astype(np.int64))
    gaps = np.flatnonzero(np.diff(p) > min(GRID, size))
    step = min(STEP, size)
    hard = [np.arange(p[g] + step, p[g + 1], step) for g in gaps]
    hard = np.concatenate(hard) if hard else np.zeros(0, np.int64)
    p = np.unique(np.concatenate((p, hard)))
    penalty = np.full(len(p), SENTENCE, np.int64)
    penalty[np.searchsorted(p, hard)] = HARD
    penalty[np.searchsorted(p, ends)] = 0
    penalty[0] = penalty[-1] = 0
    return p, penalty


def best_cuts(p: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Positions of the cuts of a cheapest packing (first 0, last the total)."""
    n = len(p)
    if n < 2:
        return p[:1]
    place = np.full(int(p[-1]) + 1, -1, np.int64)
    place[p] = np.arange(n)
    later, earlier = [], []
    k = 1
    while k <= size:
        j = np.flatnonzero(p >= k)
        i = place[p[j] - k]
        later.append(j[i >= 0])
        earlier.append(i[i >= 0])
        k *= 2
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    exact = earlier[order].tolist()
    first = np.searchsorted(later[order], np.arange(n + 1)).tolist()
    at, extra = p.tolist(), penalty.tolist()
    cost, back = [0] * n, [0] * n
    queue = deque([(0, 0)])                      # (f + p, index), increasing in both
    for j in range(1, n):
        here = at[j]
        while at[queue[0][1]] < here - size:
            queue.popleft()
        key, prev = queue[0]
        best = key + size - here
        for i in exact[first[j]:first[j + 1]]:
            if cost[i] < best:
                best, prev = cost[i], i
        best += extra[j] + 1
        cost[j], back[j] = best, prev
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return np.array([0, *reversed(cuts)], np.int64)


def pack_block(lengths: np.ndarray, sentences: np.ndarray, size: int = SIZE):
    """Pieces of a block of documents: arrays document, start, length, sequence, offset."""
    places = np.concatenate(([0], np.cumsum(lengths)))
    cuts = best_cuts(*cut_positions(places[1:], sentences, int(places[-1]), size), size)
    bounds = np.union1d(places, cuts)
    low, high = bounds[:-1], bounds[1:]
    doc = np.searchsorted(places, low, side="right") - 1
    seq = np.searchsorted(cuts, low, side="right") - 1
    return doc, low - places[doc], high - low, seq, low - cuts[seq], len(cuts) - 1


_sentence_tables: dict[str, tuple] = {}


def sentence_table(path: str):
    """By id: does its text end a sentence or a line; does its text begin with white space."""
    if path not in _sentence_tables:
        from tessera.llm.tokens import encoder

        tok = encoder(path, True).tokenizer
        n = tok.get_vocab_size()
        texts = [tok.decode([i]) for i in range(n)]
        stop = np.array([t.rstrip("\"')]»”’")[-1:] in (".", "!", "?", "…") and bool(t) for t in texts])
        line = np.array([t.endswith("\n") for t in texts])
        space = np.array([t[:1].isspace() for t in texts])
        _sentence_tables[path] = stop, line, space
    return _sentence_tables[path]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = SIZE,
                   block: int = BLOCK, roomy: bool = False) -> DataFrame:
    """Pieces of all ``docs(doc_id, text)`` in sequences of at most ``size`` tokens.

    Columns: doc_id, start (of the piece in its document), length, doc_tokens,
    sequence_id, offset (of the piece in its sequence), ids (little-endian
    unsigned 32-bit). ``roomy``: workers keep larger dictionaries of words.
    """
    def pieces(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tessera.llm.tokens import ROOMY, encoder

        enc, end = encoder(tokenizer, True, ROOMY) if roomy else encoder(tokenizer, True), struct.pack("<I", end_id)
        stop, line, space = sentence_table(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        names, parts, held = [], [], 0

        def flush():
            nonlocal sequence
            data = b"".join(parts)
            ids = np.frombuffer(data, "<u4")
            lengths = np.array([len(x) // 4 for x in parts], np.int64)
            after = np.flatnonzero((stop[ids[:-1]] & space[ids[1:]]) | line[ids[:-1]]) + 1
            doc, start, length, seq, offset, n = pack_block(lengths, after, size)
            low = (np.cumsum(length) - length) * 4
            doc_names = pa.array(names, pa.int64()).take(pa.array(doc))
            for a in range(0, len(doc), 5000):
                s = slice(a, a + 5000)
                yield pa.RecordBatch.from_arrays(
                    [doc_names[s], pa.array(start[s]), pa.array(length[s]), pa.array(lengths[doc[s]]),
                     pa.array(sequence + seq[s]), pa.array(offset[s]),
                     pa.array([data[x:x + 4 * k] for x, k in zip(low[s].tolist(), length[s].tolist())], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            sequence += n

        for batch in batches:
            for low in range(0, len(batch), 512):
                some = batch.slice(low, 512)
                for name, ids in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    names.append(name)
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= block:
                        yield from flush()
                        names, parts, held = [], [], 0
        if names:
            yield from flush()

    spark = docs.sparkSession
    ship_code(spark)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text"))
            .sortWithinPartitions("doc_id", F.xxhash64("text"))
            .mapInArrow(pieces, PIECE_SCHEMA))
