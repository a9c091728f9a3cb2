"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte context tree of depth 3. A byte's
probability comes from the longest context the language has seen; a byte new
in a context costs the context's escape probability (method C: distinct
successors over occurrences plus distinct successors) and is then looked up in
the next shorter context, down to 1/256. Statistics are frozen after training,
so a whole text's code length under a language is the sum of exact costs of
its bytes, each a function of the last four bytes; the costs of all four-byte
strings seen in training are tabulated, the rest are put together from the
shorter tables. Costs are integers (1/65536 bit), so sums don't depend on
their order. The language of the least code length wins (ties: code point
order); ``score`` is its share of the total probability of the text under
equal priors.

Every label is learned, from a documented bounded sample of its rows: the
labelled texts of least hash, at most ``TRAIN_DOCS`` of them and at least one,
each read whole. Context counts are pre-aggregated a piece of text and summed by
language and string on Spark. The cost tables are built and scored in blocks of
languages, each of at most ``CELLS`` costs of four-byte strings (a language
alone may have more), so neither labels nor texts are cut; a worker unpacks one
block at a time. Prediction reads whole texts.

Edge cases: ``und`` with score 0 for a null text, a text without a letter, or
when nothing could be learned; a null ``doc_id`` is not held out; repeated rows
get equal results; extra columns are ignored; a label without a text
of a byte or more is not learned; an empty table gives no row.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, ship_code

TRAIN_DOCS = 300
#: Costs of four-byte strings (strings times languages) and languages of a block.
CELLS, BLOCK = 1 << 24, 32
UNIT = 65536
#: A letter of any script; numerals, marks and signs are none.
_LETTER = regex.compile(r"\p{L}")
#: Bytes whose costs are looked up at a time, and texts that are decoded at a time.
_CHUNK, _SLICE = 1 << 17, 512


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _codes(data: np.ndarray, k: int) -> np.ndarray:
    """The k-byte strings that end at data[3:], as integers."""
    n = len(data) - 3
    out = np.zeros(n, np.uint32)
    for back in range(k - 1, -1, -1):
        out = (out << np.uint32(8)) | data[3 - back:3 - back + n]
    return out


def context_counts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For k = 1 to 4: the sorted k-byte strings of the texts (three zero bytes before each) and their counts."""
    parts = [np.frombuffer(b"\0\0\0" + t, np.uint8) for t in texts if t]
    out = []
    for k in range(1, 5):
        codes = np.concatenate([_codes(p, k) for p in parts]) if parts else np.zeros(0, np.uint32)
        out.append(np.unique(codes, return_counts=True))
    return out


def _bits(p: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(p) * UNIT).astype(np.int64)


class Model:
    """Frozen cost tables of some languages."""

    def __init__(self, counts: dict[str, list[tuple[np.ndarray, np.ndarray]]]):
        self.languages = sorted(counts)
        trees = [counts[x] for x in self.languages]
        n = len(trees)
        #: cost of each byte without context
        self.cost1 = np.stack([self._order(t[0], np.arange(256, dtype=np.uint32), None)[0] for t in trees], 1)
        every2 = np.arange(1 << 16, dtype=np.uint32)
        self.cost2 = np.stack([self._order(t[1], every2, self.cost1[every2 & 255, i])[0] for i, t in enumerate(trees)], 1)
        self.escape2 = np.stack([self._escapes(t[2], every2) for t in trees], 1)
        self.seen3 = np.unique(np.concatenate([t[2][0] for t in trees])) if n else np.zeros(0, np.uint32)
        self.cost3 = np.stack([self._order(t[2], self.seen3, self.cost2[self.seen3 & 65535, i])[0] for i, t in enumerate(trees)], 1)
        self.context3 = np.unique(np.concatenate([t[3][0] >> np.uint32(8) for t in trees]))
        self.escape3 = np.stack([self._escapes(t[3], self.context3) for t in trees], 1)
        self.seen4 = np.unique(np.concatenate([t[3][0] for t in trees]))
        lower = self._cost3(self.seen4 & np.uint32(0xFFFFFF))
        self.cost4 = np.stack([self._order(t[3], self.seen4, lower[:, i])[0] for i, t in enumerate(trees)], 1)

    @staticmethod
    def _contexts(tree):
        """Sorted contexts of a tree level, their occurrences and distinct successors."""
        codes, counts = tree
        context, start = np.unique(codes >> np.uint32(8), return_index=True)
        distinct = np.diff(np.append(start, len(codes)))
        return context, np.add.reduceat(counts, start) if len(codes) else counts, distinct

    @classmethod
    def _escapes(cls, tree, contexts: np.ndarray) -> np.ndarray:
        """Escape cost of each context, 0 if the language hasn't seen it."""
        own, total, distinct = cls._contexts(tree)
        out = np.zeros(len(contexts), np.int64)
        if len(own):
            at = np.minimum(np.searchsorted(own, contexts), len(own) - 1)
            hit = own[at] == contexts
            out[hit] = _bits(distinct[at[hit]] / (total[at[hit]] + distinct[at[hit]]))
        return out

    @classmethod
    def _order(cls, tree, strings: np.ndarray, lower: np.ndarray | None):
        """Cost of each string's last byte after the rest; ``lower``: its cost in the next shorter context."""
        codes, counts = tree
        if lower is None:
            lower = np.full(len(strings), 8 * UNIT, np.int64)
        contexts = strings >> np.uint32(8)
        cost = lower + cls._escapes(tree, contexts)
        if len(codes):
            own, total, distinct = cls._contexts(tree)
            at = np.minimum(np.searchsorted(codes, strings), len(codes) - 1)
            hit = codes[at] == strings
            c = np.searchsorted(own, contexts[hit])
            cost[hit] = _bits(counts[at[hit]] / (total[c] + distinct[c]))
        return cost, contexts

    def _cost3(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.seen3, codes), len(self.seen3) - 1)
        cost = self.cost3[at]
        miss = np.flatnonzero(self.seen3[at] != codes)
        cost[miss] = self.escape2[codes[miss] >> np.uint32(8)] + self.cost2[codes[miss] & np.uint32(65535)]
        return cost

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Costs (rows: strings of four bytes, columns: languages)."""
        at = np.minimum(np.searchsorted(self.seen4, codes), len(self.seen4) - 1)
        cost = self.cost4[at]
        miss = np.flatnonzero(self.seen4[at] != codes)
        if len(miss):
            codes = codes[miss]
            low = self._cost3(codes & np.uint32(0xFFFFFF))
            context = codes >> np.uint32(8)
            c = np.minimum(np.searchsorted(self.context3, context), len(self.context3) - 1)
            seen = self.context3[c] == context
            low[seen] += self.escape3[c[seen]]
            cost[miss] = low
        return cost

    def code_lengths(self, texts: list[bytes], skip: list[np.ndarray] | None = None):
        """Code length of each text under each language, in 1/UNIT bits; with ``skip``, true for some
        bytes of each text, also the part of it that falls on them."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        skipped = np.zeros_like(out)
        which, parts, left_out, held = [], [], [], 0

        def flush():
            data = np.frombuffer(b"".join(parts), np.uint8)
            ends = np.cumsum([len(p) for p in parts])
            starts = ends - [len(p) for p in parts]        # of the costs of bytes 3 on: index i is byte i + 3
            cost = self.costs(_codes(data, 4))
            edges = np.stack((starts, ends - 3), 1).ravel()
            sums = np.add.reduceat(np.concatenate((cost, np.zeros((1, cost.shape[1]), np.int64))), edges, axis=0)[::2]
            np.add.at(out, which, sums)
            for i, start, at in zip(which, starts, left_out):
                skipped[i] += cost[start + at].sum(axis=0)

        for i, text in enumerate(texts):
            for low in range(0, len(text), _CHUNK):
                part = text[max(0, low - 3):low + _CHUNK]
                parts.append(part if low else b"\0\0\0" + part)
                which.append(i)
                if skip is not None:
                    left_out.append(np.flatnonzero(skip[i][low:low + _CHUNK]))
                held += len(parts[-1])
                if held >= _CHUNK:
                    flush()
                    which, parts, left_out, held = [], [], [], 0
        if parts:
            flush()
        return out if skip is None else (out, skipped)


    def dear_words(self, text: bytes, skip: np.ndarray, bits: float) -> float:
        """Share of the words that cost ``bits`` a byte or more, of those with bytes outside ``skip`` (whose
        costs count only), under the language with the fewest; a word across the border of two pieces of
        ``_CHUNK`` bytes is two."""
        data, words, dear = np.frombuffer(b"\0\0\0" + text, np.uint8), 0, np.zeros(len(self.languages), np.int64)
        for low in range(0, len(text), _CHUNK):
            piece, out = data[low:low + _CHUNK + 3], skip[low:low + _CHUNK]
            cost = self.costs(_codes(piece, 4))
            space = (piece[3:] == 32) | (piece[3:] >= 9) & (piece[3:] <= 13)
            own = ~(space | out)
            word = np.cumsum(space)[own]
            n = np.bincount(word)
            real = n > 0
            words += int(real.sum())
            for i in range(len(dear)):
                dear[i] += int((np.bincount(word, cost[own, i])[real] >= bits * UNIT * n[real]).sum())
        return int(dear.min()) / words if words else 0.0


def no_evidence(text: str, letters: np.ndarray) -> np.ndarray:
    """Of each byte of a text, whether its cost says nothing: it is one of the first three, whose contexts
    reach before the text, or belongs to a character that is not among ``letters`` (truth by code point)."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    out = np.repeat(~letters[points], 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))
    out[:3] = True
    return out


def _counted(batches):
    """Strings ``code`` of ``k`` bytes and their counts ``n`` in pieces of the texts, a row a string."""
    import pyarrow as pa

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = b"\0\0\0" + text.encode()
            for low in range(0, len(data) - 3, _CHUNK):
                piece = np.frombuffer(data[low:low + _CHUNK + 3], np.uint8)
                for k in range(1, 5):
                    codes, n = np.unique(_codes(piece, k), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(np.full(len(codes), k, np.int32)),
                                                      pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "k", "code", "n"])


def _packed(batches):
    """The strings and counts of a language and length in a batch as one row."""
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        lang, level = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        k, codes, n = (batch.column(i).to_numpy() for i in (1, 2, 3))
        names, kinds, strings, counts = [], [], [], []
        for i, name in enumerate(lang):
            for length in range(1, 5):
                here = (level == i) & (k == length)
                names.append(name)
                kinds.append(length)
                strings.append(codes[here].astype("<u4").tobytes())
                counts.append(n[here].astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.int32()), pa.array(strings, pa.binary()), pa.array(counts, pa.binary())],
                                         names=["lang", "k", "codes", "counts"])


def blocks_of(sizes: dict[str, int], cells: int = CELLS, block: int = BLOCK) -> list[list[str]]:
    """Languages in code point order, cut into runs of at most ``block`` whose strings times languages stay within ``cells``."""
    out, held = [], 0
    for lang in sorted(sizes):
        if not out or len(out[-1]) == block or (held + sizes[lang]) * (len(out[-1]) + 1) > cells:
            out.append([])
            held = 0
        out[-1].append(lang)
        held += sizes[lang]
    return out


def sample(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``lang, text`` of the rows to learn from: of every label those of least hash."""
    space = 1 << 30
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        (F.col("text") != "") & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id", "text"))
    at = F.pmod("h", F.lit(space))
    # a hash threshold that about 1.3 * train_docs texts of each label pass, the least one always: a label's rows are bounded before they meet
    limits = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("count"), F.min(at).alias("least")).select(
        "lang", F.greatest(F.col("least") + 1, F.lit(1.3 * train_docs * space) / F.col("count")).alias("limit"))
    near = rows.join(F.broadcast(limits), "lang").where(at < F.col("limit")).select("lang", "h", "text").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(at, "h", "text"))
    return near.withColumn("place", place).where(F.col("place") <= train_docs).select("lang", "text")


def characters(tree: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Code points of the characters that a language's strings of one to four bytes hold."""
    one, two, three, four = (t[0].astype(np.uint32) for t in tree)
    two, three, four = two[two >> 8 >= 0xC2], three[three >> 16 >= 0xE0], four[four >> 24 >= 0xF0]
    three = three[three >> 16 < 0xF0]
    two = two[two >> 8 < 0xE0]
    return np.concatenate((one[one < 0x80], (two >> 8 & 31) << 6 | two & 63, (three >> 16 & 15) << 12 | (three >> 8 & 63) << 6 | three & 63,
                           (four >> 24 & 7) << 18 | (four >> 16 & 63) << 12 | (four >> 8 & 63) << 6 | four & 63))


class Learned(NamedTuple):
    #: the pickled ``Model`` of each block of languages
    blocks: list[Broadcast]
    #: by code point, whether a learned text holds the character
    letters: Broadcast


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, cells: int = CELLS, block: int = BLOCK) -> Learned | None:
    """Learn from ``docs(doc_id, text, lang)`` that are not held out; None if there is nothing to learn from."""
    spark = docs.sparkSession
    ship_code(spark)
    chosen = materialise(sample(docs, train_docs), "ppm-sample")
    found = chosen.mapInArrow(_counted, "lang string, k int, code long, n long").groupBy("lang", "k", "code").agg(F.sum("n").alias("n"))
    counts = materialise(found, "ppm-contexts")
    sizes = {r["lang"]: r["count"] for r in counts.where("k = 4").groupBy("lang").count().collect()}
    out, letters = [], np.zeros(0x110000, bool)
    for langs in blocks_of(sizes, cells, block):
        own = counts.where(F.col("lang").between(langs[0], langs[-1]))      # UTF-8 bytes and code points sort alike
        parts: dict[tuple, list] = {}
        for r in own.mapInArrow(_packed, "lang string, k int, codes binary, counts binary").toLocalIterator():
            parts.setdefault((r["lang"], r["k"]), []).append((np.frombuffer(r["codes"], "<u4"), np.frombuffer(r["counts"], "<i8")))
        trees = {}
        for lang in langs:
            trees[lang] = []
            for k in range(1, 5):
                codes, n = (np.concatenate(x) for x in zip(*parts[lang, k]))
                order = np.argsort(codes)
                trees[lang].append((codes[order], n[order]))
            letters[characters(trees[lang])] = True
        out.append(spark.sparkContext.broadcast(pickle.dumps(Model(trees))))
    return Learned(out, spark.sparkContext.broadcast(letters)) if out else None


_models: dict[str, Model] = {}


def _each_model(name: str, sent: list[Broadcast]) -> Iterator[Model]:
    """The blocks' models in turn; a single one is kept, of several only the current one and no pickled copy."""
    if len(sent) == 1:
        if name not in _models:
            _models.clear()
            _models[name] = pickle.loads(sent[0].value)
        yield _models[name]
        return
    for one in sent:
        model = pickle.loads(one.value)
        one.__dict__.pop("_value", None)                # reread from the executor's file for the next batch
        yield model


def predict(docs: DataFrame, learned: Learned | None, keep: tuple[str, ...] = ("doc_id",), evidence: float | None = None) -> DataFrame:
    """Columns ``keep`` (text among them, if wanted, comes last), ``lang_pred``, ``score`` and
    ``bits_per_byte`` (of the best language, null for ``und``).

    With ``evidence``, a number of bits a byte, also ``n_bytes``, ``judged_bytes`` (those that
    ``no_evidence`` leaves), ``judged_bits``, the least that they cost in a language, and ``dear_words``,
    the least share of words at that rate or above in a language (0 where the judged bytes as a whole
    are below it). The language predicted needn't be that one: noise in a text costs least in a label of few rows.
    """
    spark = docs.sparkSession
    ship_code(spark)
    name = uuid.uuid4().hex
    sent = learned.blocks if learned else []
    letters = learned.letters if learned else None

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, texts = batch.num_rows, batch.column(batch.num_columns - 1)
            best, least, total = np.full(n, "und", object), np.full(n, -1, np.int64), np.zeros(n)
            size, judged, part, dear = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            for model in _each_model(name, sent):
                for low in range(0, n, _SLICE):
                    some = texts.slice(low, _SLICE).to_pylist()
                    real = [i for i, t in enumerate(some) if t and _LETTER.search(t)]
                    if not real:
                        continue
                    data, at = [some[i].encode() for i in real], low + np.array(real)
                    skip = [no_evidence(some[i], letters.value) for i in real] if evidence else None
                    length, skipped = model.code_lengths(data, skip) if evidence else (model.code_lengths(data), None)
                    own, found = length.min(axis=1), np.array(model.languages, object)[length.argmin(axis=1)]
                    share = np.exp2(-np.minimum((length - own[:, None]) / UNIT, 1000.0)).sum(axis=1)
                    first = least[at] < 0
                    before = np.where(first, own, least[at])
                    both = np.minimum(before, own)                    # ties: the earlier block, in code point order
                    total[at] = (np.where(first, 0, total[at]) * np.exp2(-np.minimum((before - both) / UNIT, 1000.0))
                                 + share * np.exp2(-np.minimum((own - both) / UNIT, 1000.0)))
                    best[at] = np.where(first | (own < before), found, best[at])
                    least[at] = both
                    size[at] = [len(t) for t in data]
                    if evidence:
                        kept = (length - skipped).min(axis=1)
                        judged[at] = [len(x) - int(x.sum()) for x in skip]
                        words = [model.dear_words(t, x, evidence) if k and c >= evidence * UNIT * k else 0.0
                                 for t, x, k, c in zip(data, skip, judged[at].tolist(), kept.tolist())]
                        dear[at] = np.where(first, words, np.minimum(dear[at], words))
                        part[at] = np.where(first, kept, np.minimum(part[at], kept))
            known = least >= 0
            score = np.divide(1, total, out=np.zeros(n), where=known)
            rate = pa.array(np.divide(least / UNIT, size, out=np.zeros(n), where=known), mask=~known)
            more = [pa.array(size), pa.array(judged), pa.array(part / UNIT), pa.array(dear)] if evidence else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(out)], pa.array(best, pa.string()), pa.array(score), rate, *more],
                                             names=[*out, "lang_pred", "score", "bits_per_byte", *added])

    rows = docs.select(*(c for c in keep if c != "text"), F.col("text").cast("string").alias("text"))
    out = [c for c in rows.columns if c in keep]
    kinds = dict(rows.dtypes)
    added = {"n_bytes": "long", "judged_bytes": "long", "judged_bits": "double", "dear_words": "double"} if evidence else {}
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in out), "lang_pred string, score double, bits_per_byte double", *(f"{c} {k}" for c, k in added.items())]))
