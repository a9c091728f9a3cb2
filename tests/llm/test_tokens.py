"""Encoding, Re-Pair files and packing against whole-text encoding and brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing, repair, tokens
from tessera.llm.queries import vocabulary
from tessera.llm.tokens import ChunkEncoder
from tests.llm.conftest import hard_rows

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")


def whole(path, texts, end):
    enc = Tokenizer.from_file(path)
    enc.encode_special_tokens = True
    return [[*e.ids, end] for e in enc.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path,spaces", [(BYTE, True), (WORD, False)])
def test_chunks_equal_whole_texts(path, spaces):
    rnd = random.Random(3)
    bits = ["a", "The", "é", "é", "́", " ", "  ", "\n", " \n", "\n ", "\t", "'s", "12", "!", ".", "\x1c", "\x85", "\xa0", "　",
            "<|endoftext|>", "\r\n", "​", "İ", "Σ", "\0", "word"]
    texts = [None, "", *("".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(4000))]
    enc = ChunkEncoder(path, spaces)
    enc.MOST, enc.KEEP = 300, 100                    # the dictionary is cut back many times
    got = [x for i in range(0, len(texts), 200) for x in enc.encode(texts[i:i + 200])]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == want


@pytest.mark.parametrize("path,spaces,text,spellings", [
    (BYTE, True, "x Zorbleq Zorbleq, Zorbleq!\nZorbleq Zorbleq?", [" Zorbleq", "Zorbleq"]), (WORD, False, "Zorbleq zorbleq, ZORBLEQ! zorbleq", ["zorbleq"])])
def test_a_spelling_of_letters_reaches_the_model_once(path, spaces, text, spellings):
    enc, asked = ChunkEncoder(path, spaces), []

    class Model:
        model = enc.model

        def tokenize(self, word):
            asked.append(word.replace("\u0120", " "))
            return self.model.tokenize(word)

    enc.model = Model()
    want = np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert enc.encode([text, None, text]) == [want, b"", want]
    assert sorted(asked) == sorted(spellings)


@pytest.mark.parametrize("path,spaces", [(BYTE, True), (WORD, False)])
def test_punctuation_after_letters_equals_whole_texts_and_shares_their_ids(path, spaces):
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    rnd, enc = random.Random(5), ChunkEncoder(path, spaces)
    texts = [f"x {word}{''.join(rnd.choice(marks) for _ in range(rnd.randint(0, 4)))}{rnd.choice(['', ' y', chr(10) + 'Word' + rnd.choice(marks)])}"
             for word in ("word", "Été", "ŀa", "I") for _ in range(1500)] + [f"a Ab{m}{n}" for m in marks for n in ["", *marks]]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want
    odd, ids = [], enc._ids
    enc._ids = lambda x: odd.extend(x) or ids(x)
    enc.encode(["x zorb))) Zorb### zorb&"])
    assert not [x for x in odd if "orb" in x]


def test_distinct_chunks_of_plain_texts_are_looked_up_once():
    asked = []

    class Known(dict):
        def get(self, key, *default):
            asked.append(key)
            return super().get(key, *default)

    enc = ChunkEncoder(WORD, False)
    enc.known = Known()
    texts = ["Zorb é\xa0zorb\x0bÉté ", None, " zorb  ZORB\n", "", "\t\n", "ZORB\x1czorb", "zorb"] * 50
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert enc.encode(texts) == want and asked.count("zorb") == 1
    asked.clear()
    assert enc.encode(texts) == want and asked.count("zorb") == 1


@pytest.mark.parametrize("path,spaces", [(BYTE, True), (WORD, False)])
def test_stops_after_known_letters_do_not_reach_the_model_again(path, spaces):
    enc = ChunkEncoder(path, spaces)
    enc.encode(["x zorbleq été"])
    spelt, spellings = [], enc._spellings
    enc._spellings = lambda words: spelt.extend(words) or spellings(words)
    text = "x zorbleq, Été. été! zorbleq?\nzorbleq."
    assert enc.encode([text]) == [np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert spelt == ([" Été", "zorbleq"] if spaces else [])


@pytest.mark.parametrize("path,spaces", [(BYTE, True), (WORD, False)])
def test_long_runs_of_stops_after_letters_share_their_ids(path, spaces):
    marks, rnd, enc = [chr(c) for c in range(33, 127) if not chr(c).isalnum()], random.Random(6), ChunkEncoder(path, spaces)
    texts = [f"x {w}{''.join(rnd.choice(marks) for _ in range(rnd.randint(3, 11)))} y" for w in ("word", "Été", "I") for _ in range(500)]
    enc.around = dict.fromkeys(map(str, range(60_000)), b"")        # more than are kept
    assert enc.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(enc.around) < 5000
    odd, ids = [], enc._ids
    enc._ids = lambda x: odd.extend(x) or ids(x)
    enc.encode(["x zorb.&&& Zorb,,,,####"])
    assert not [x for x in odd if "orb" in x]


def test_stops_after_ascii_letters_are_chunks_of_their_own():
    enc = ChunkEncoder(WORD, False)
    texts = ["Zorb, zorb. zorb's zorb,'s (zorb) é, a»! 'll ab.cd..ef", "zorb,", ",", "z\x7f,"]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want
    assert {"zorb", ",", ".", "(zorb", ")", "zorb's", ",'s", "ab", ".cd", "..ef", "é,", "a»!", "'ll"} == enc.known.keys() - {"z\x7f,"}


def test_slabs_hold_all_rows_in_bounded_slices(monkeypatch):
    monkeypatch.setattr(tokens, "SLAB", 100)
    texts = [None, "", *["é" * (i % 90) for i in range(300)], "x" * 1000, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = list(tokens.slabs(batch, 1))
    assert [r for x in got for r in x.column(0).to_pylist()] == list(range(len(texts)))
    assert all(sum(len((t or "").encode()) for t in x.column(1).to_pylist()[1:]) <= 200 for x in got if "x" * 1000 not in x.column(1).to_pylist())
    assert not list(tokens.slabs(batch.slice(0, 0), 1)) and [len(x) for x in tokens.slabs(batch.slice(0, 1), 1)] == [1]


def test_many_pairs_are_ranked_as_few_are(monkeypatch):
    pairs = np.random.default_rng(2).zipf(1.3, 5000).clip(max=900).astype(np.uint64) << np.uint64(32)
    few, ranks = repair._ranked(pairs, 5)
    monkeypatch.setattr(repair, "_MANY", 1)
    many, hashed = repair._ranked(pairs, 5)
    assert many.tolist() == few.tolist() and (hashed[ranks != repair._NONE] <= ranks[ranks != repair._NONE]).all()
    assert len(repair._ranked(pairs, 5001)[0]) == 0


def test_an_encoder_takes_the_size_of_its_dictionary():
    assert tokens.encoder(WORD, False, (5, 3)) is tokens.encoder(WORD, False, tokens.ROOMY)
    enc = tokens.encoder(WORD, False, (5, 3))
    enc.known.clear()
    words = "one two three four five six seven"
    first = enc.encode([words])
    assert enc.encode([words]) == first and len(enc.known) == 7
    enc.encode(["eight"])
    assert list(enc.known)[:3] == ["one", "two", "three"] and len(enc.known) == 4
    assert tokens.encoder(WORD, False).MOST == ChunkEncoder.MOST


def test_repair_round_trip_and_random_access():
    rnd = np.random.default_rng(1)
    lengths = np.array([1, 1, 700, 3000, 2, 900])
    ids = rnd.integers(0, 6, lengths.sum()).astype(np.uint32)
    ids[np.cumsum(lengths) - 1] = 1
    shard = repair.Shard(repair.pack([None, 0, 1, 2, 2, 9], lengths, ids))
    assert len(shard.rules) > 5 and len(shard.symbols) < 0.7 * len(ids)
    at = 0
    for i, n in enumerate(lengths):
        own = ids[at:at + n]
        assert (shard.document(i) == own).all()
        assert [shard.token(i, k) for k in range(0, n, 97)] == own[::97].tolist()
        at += n
    assert shard.doc_id(0) is None and shard.doc_id(5) == 9
    assert shard.rule_lengths.tolist() == [len(shard.expand(np.array([shard.first + r], np.uint32))) for r in range(len(shard.rules))]


@pytest.mark.parametrize("name,ids,most", [
    ("run", np.full(100_000, 5), 100), ("period", np.tile(np.arange(50), 2000), 5000), ("falling", np.tile(np.arange(50)[::-1], 2000), 5000),
    ("two", np.tile([1, 1, 2], 30_000), 200), ("runs", np.concatenate([np.full(2000 + 7 * i, i) for i in range(20)]), 2000)])
def test_repair_of_repetitive_documents(name, ids, most):
    ids = ids.astype(np.uint32)
    half = len(ids) // 2
    shard = repair.Shard(repair.pack([1, 2], np.array([half, len(ids) - half]), ids))
    assert len(shard.symbols) < most and len(shard.rules) > 5
    assert (np.concatenate((shard.document(0), shard.document(1))) == ids).all()
    assert [shard.token(0, k) for k in range(0, half, 997)] == ids[:half:997].tolist()


def test_repair_leaves_no_frequent_pair():
    rnd = np.random.default_rng(4)
    ids = rnd.zipf(1.5, 60_000).clip(max=400).astype(np.uint32)
    ends = np.zeros(len(ids), bool)
    ends[rnd.integers(0, len(ids), 300)] = ends[-1] = True
    symbols, left, rules, first = repair.compress(ids, ends)
    assert left.sum() == ends.sum()
    seen = {}
    last = None
    for i in np.flatnonzero(~left[:-1]).tolist():
        pair = (int(symbols[i]), int(symbols[i + 1]))
        if not (last == (i - 1, pair)):                     # occurrences that don't overlap
            seen[pair] = seen.get(pair, 0) + 1
            last = (i, pair)
    assert max(seen.values()) < repair.LEAST + repair.USEFUL
    places = repair.chosen_places(np.array([3, 4, 5, 9, 10, 11, 12, 20]), np.array([5, 1, 5, 4, 3, 2, 1, 0]))
    assert places.tolist() == [False, True, False, True, False, False, True, True]


def test_token_files(spark, docs, no_docs, tmp_dir):
    repair.write_tokens(docs, f"{tmp_dir}/t", WORD, 1, shard_tokens=3000)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in repair.read_tokens(spark, f"{tmp_dir}/t").collect())
    rows = hard_rows()
    ids = whole(WORD, [r[1] for r in rows], 1)
    want = sorted(((-1 if r[0] is None else r[0]), len(x), np.array(x, "<u4").tobytes()) for r, x in zip(rows, ids))
    assert sorted((-1 if d is None else d, n, x) for _, d, n, x in got) == want
    at = 0
    for start, _, n, _ in got:                       # ascending doc_id, no gap
        assert start == at
        at += n
    order = [-1 if d is None else d for _, d, _, _ in got]
    assert order == sorted(order)
    repair.write_tokens(no_docs, f"{tmp_dir}/e", WORD, 1)
    assert repair.read_tokens(spark, f"{tmp_dir}/e").count() == 0


def cost(cuts, p, penalty, size):
    extra = dict(zip(p.tolist(), penalty.tolist()))
    total = 0
    for a, b in zip(cuts, cuts[1:]):
        n = b - a
        assert 0 < n <= size
        total += 1 + extra[b] + (0 if n & (n - 1) == 0 else size - n)
    return total


def test_cuts_are_cheapest():
    rnd = np.random.default_rng(2)
    for _ in range(40):
        size = int(rnd.choice([4, 16, 64]))
        total = int(rnd.integers(1, 300))
        ends = np.unique(np.append(rnd.integers(1, total + 1, 4), total))
        p, penalty = packing.cut_positions(ends, np.unique(rnd.integers(1, total + 1, 20)), total, size)
        best = [0] + [10 ** 9] * (len(p) - 1)
        for j in range(1, len(p)):
            for i in range(j):
                n = int(p[j] - p[i])
                if n <= size:
                    best[j] = min(best[j], best[i] + 1 + int(penalty[j]) + (0 if n & (n - 1) == 0 else size - n))
        cuts = packing.best_cuts(p, penalty, size).tolist()
        assert cuts[0] == 0 and cuts[-1] == total and cost(cuts, p, penalty, size) == best[-1]


def test_packing(docs, no_docs):
    rows = hard_rows()
    texts = sorted(whole(BYTE, [r[1] for r in rows], 0))
    pieces = packing.pack_documents(docs, BYTE, 0, block=4000).collect()
    sequences, documents = {}, []
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert len(ids) == p["length"] > 0
        assert sequences.get(p["sequence_id"], 0) == p["offset"]           # gapless
        sequences[p["sequence_id"]] = p["offset"] + p["length"]
        if p["start"] == 0:                          # pieces of a document follow each other in the stream
            documents.append([])
        assert len(documents[-1]) == p["start"]
        documents[-1] += ids
    assert sorted(documents) == texts and max(sequences.values()) <= 1024
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in sequences.values())
    assert padding < 0.2 * sum(sequences.values())   # short blocks; whole tables stay near 1 %
    assert packing.pack_documents(no_docs, BYTE, 0).count() == 0


def test_queries_digests(spark):
    from tessera.llm.queries import op2_repair_tokens

    d = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    names = sorted(rows)
    at = 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in op2_repair_tokens(spark, d).collect()}
    for name, ids in zip(names, whole(WORD, [rows[n] for n in names], 1)):
        assert got[name] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_encoding_does_not_look_for_cycles():
    import gc

    enc, inside, seen = ChunkEncoder(WORD, False), False, []

    def noted(phase, info):
        if inside and phase == "start":
            seen.append(info)

    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(9000)]
    gc.callbacks.append(noted)
    try:
        inside = True
        enc.encode([" ".join(words), None, "x"])
        inside = False
    finally:
        gc.callbacks.remove(noted)
    assert seen == [] and gc.isenabled()
