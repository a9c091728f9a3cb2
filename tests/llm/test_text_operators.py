"""Language ID, SimHash, LM scores, mixing and chat formatting against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import chat, lm_score, mixing, ppm, simhash
from tests.llm.conftest import EN, FR, hard_rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- PPM ------------------------------------------------------------------------

def slow_bits(counts, text):
    """Code length of a text by following the escapes byte by byte."""
    trees = [{int(c): int(n) for c, n in zip(*level)} for level in counts]
    data, total = b"\0\0\0" + text, 0
    for i in range(3, len(data)):
        bits = 0
        for k in (4, 3, 2, 1):
            context = data[i - k + 1:i]
            after = {c: n for c, n in trees[k - 1].items() if (c >> 8) == int.from_bytes(context, "big")}
            n, d = sum(after.values()), len(after)
            hit = after.get(int.from_bytes(context + data[i:i + 1], "big"))
            if hit:
                bits += round(-math.log2(hit / (n + d)) * ppm.UNIT)
                break
            if d:
                bits += round(-math.log2(d / (n + d)) * ppm.UNIT)
        else:
            bits += 8 * ppm.UNIT
        total += bits
    return total


def test_ppm_code_lengths_are_exact(monkeypatch):
    counts = {"en": ppm.context_counts([EN.encode() * 2, b"Zz"]), "fr": ppm.context_counts([FR.encode()])}
    model = ppm.Model(counts)
    texts = [b"The fox", b"le renard \xc3\xa9t\xc3\xa9", b"\xff\x00", b"q", b"the lazy renard runs from the maison " * 3]
    want = [[slow_bits(counts[x], t) for x in ("en", "fr")] for t in texts]
    assert model.code_lengths(texts).tolist() == want
    monkeypatch.setattr(ppm, "_CHUNK", 7)            # long texts go in pieces
    assert model.code_lengths(texts).tolist() == want


def test_ppm_predicts(docs, no_docs):
    model = ppm.train(docs)
    got = {(r["doc_id"], r["text"]): r for r in ppm.predict(docs, model, keep=("doc_id", "text", "key")).collect()}
    for row in hard_rows():
        r = got[row[0], row[1]]
        assert 0 <= r["score"] <= 1 and r["key"] == "x"
        if row[1] is None or not re.search(r"[^\W\d_]", row[1]):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif row[2] and len(row[1]) > 100 and row[0] != 7:
            assert r["lang_pred"] == row[2]
    assert ppm.train(no_docs) is None and ppm.predict(no_docs, None).count() == 0
    assert {r["lang_pred"] for r in ppm.predict(docs, None).collect()} == {"und"}


def test_numerals_and_marks_are_no_letters(spark, docs):
    """What is a letter is Unicode's general category L, here read off unicodedata."""
    import unicodedata

    model = ppm.train(docs)
    signs = ["½", "² ①", "Ⅷ", "٣", "\u0301", "12 34", "_", "😀", "〇", "ª", "ǅ", "ʰ", "中", "a1", "— x"]
    asked = spark.createDataFrame([(i, s, None) for i, s in enumerate(signs)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in ppm.predict(asked, model).collect()}
    for i, s in enumerate(signs):
        if any(unicodedata.category(c)[0] == "L" for c in s):
            assert got[i][0] in ("en", "fr") and got[i][1] > 0
        else:
            assert got[i] == ("und", 0)


def test_ppm_learns_every_label_from_whole_texts(spark):
    """70 labels, each in letters of its own that stand after character 8,000 of its only learned text, scored in several blocks too."""
    def words(i):
        return " ".join(chr(0x4E00 + 40 * i + j) + chr(0x4E00 + 40 * i + (3 * j) % 40) for j in range(40))

    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[i], "a b " * 2100 + words(i), f"x{i:03}") for i in range(70)]
    # one label's only text stands in many repeated rows
    rows += [rows[7]] * 900
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = spark.createDataFrame([(i, words(i), None) for i in range(70)], docs.schema)
    got = []
    for size in (1000, 6):
        learned = ppm.train(docs, block=size)
        assert len(learned.blocks) == -(-70 // size)
        got.append({r["doc_id"]: r for r in ppm.predict(asked, learned).collect()})
        assert [got[-1][i]["lang_pred"] for i in range(70)] == [f"x{i:03}" for i in range(70)]
    assert all(a["bits_per_byte"] == got[1][i]["bits_per_byte"] and abs(a["score"] - got[1][i]["score"]) < 1e-12 for i, a in got[0].items())
    want = ppm.Model({r[2]: ppm.context_counts([r[1].encode()]) for r in rows})
    lengths = want.code_lengths([words(i).encode() for i in range(70)])
    assert all(round(got[0][i]["bits_per_byte"] * len(words(i).encode()) * ppm.UNIT) == lengths[i].min() for i in range(70))


def test_ppm_blocks_are_bounded():
    sizes = {f"x{i:03}": 10 + i for i in range(100)}
    parts = ppm.blocks_of(sizes, cells=1000, block=8)
    assert sum(parts, []) == sorted(sizes) and all(len(p) <= 8 for p in parts)
    assert all(len(p) == 1 or len(p) * sum(sizes[x] for x in p) <= 1000 for p in parts)
    assert ppm.blocks_of({}) == [] and ppm.blocks_of({"a": 10 ** 12, "b": 1}) == [["a"], ["b"]]


def test_ppm_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = ppm.predict(docs, ppm.train(docs), keep=("doc_id", "lang")).where(ppm.held_out(F.col("doc_id")))
    assert r.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


# --- SimHash ---------------------------------------------------------------------

def slow_fingerprint(text):
    words = WORDS.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    label = list(range(len(fps)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_documents(docs, no_docs):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs, keep=("doc_id", "key")).collect()), key=str)
    rows = hard_rows()
    fps = [slow_fingerprint(r[1]) for r in rows]
    part = slow_components(fps)
    least = {}
    for r, p in zip(rows, part):
        if r[0] is not None:
            least[p] = min(least.get(p, r[0]), r[0])
    assert got == sorted(((r[0], f"{f:016x}", least.get(p)) for r, f, p in zip(rows, fps, part)), key=str)
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("cell", [3, 1000])
def test_simhash_links_are_whole(spark, cell):
    """Dense clouds of fingerprints; small cells go through block pairs."""
    rnd = random.Random(5)
    fps = set()
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(25):
            x = base
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.components(rows, cell=cell).collect()}
    assert [got[i] for i in range(len(fps))] == slow_components(fps)


def test_embedding_bounds_the_distance(spark):
    rnd = random.Random(8)
    fps = [rnd.getrandbits(64) for _ in range(200)] + [0, (1 << 64) - 1, 1 << 63]
    e = [r[0] % (1 << 64) for r in spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "i long, fp long")
         .orderBy("i").select(simhash.embedding(F.col("fp"))).collect()]
    counts = [[(x >> 2 * s) & 3 for s in range(32)] for x in e]
    assert counts == [[bin((f >> 2 * s) & 3).count("1") for s in range(32)] for f in fps]
    a, b = np.array(e, np.uint64)[:, None], np.array(e, np.uint64)[None, :]
    assert simhash.manhattan(a, b).tolist() == [[sum(abs(x - y) for x, y in zip(c, d)) for d in counts] for c in counts]


# --- LM scores --------------------------------------------------------------------

def slow_scores(texts):
    docs = [[w.lower() if w.isascii() else w for w in WORDS.findall(t or "")] for t in texts]
    grams = [[Counter(tuple(d[i - k + 1:i + 1]) for i in range(k - 1, len(d))) for k in (1, 2, 3)] for d in docs]
    total = [sum((g[k] for g in grams), Counter()) for k in range(3)]
    words = sum(map(len, docs))
    for d, own in zip(docs, grams):
        micro, used = 0, [0, 0, 0, 0]
        for i in range(len(d)):
            most = min(i + 1, 3)
            for k in range(most, 0, -1):
                gram = tuple(d[i - k + 1:i + 1])
                c = total[k - 1][gram] - own[k - 1][gram]
                if c:
                    below = words - len(d) if k == 1 else total[k - 2][gram[:-1]] - own[k - 2][gram[:-1]]
                    ratio = c / below
                    break
            else:
                k, ratio = 0, 1 / (words - len(d) + 1)
            used[k] += 1
            micro += round(1e6 * (math.log(ratio) + (most - k) * math.log(0.4)))
        yield len(d), micro / 1e6, used


def test_stupid_backoff(docs, no_docs):
    got = sorted(((r["doc_id"], r["n_words"], r["log_score"], list(r["used"])) for r in lm_score.score_documents(docs).collect()), key=str)
    rows = hard_rows()
    want = sorted(((r[0], *s) for r, s in zip(rows, slow_scores([r[1] for r in rows]))), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:2] == b[:2] and a[3] == b[3] and abs(a[2] - b[2]) < 2e-5
    assert lm_score.score_documents(no_docs).count() == 0


# --- mixing -----------------------------------------------------------------------

def slow_targets(sizes, share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, full = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set()
    while left > 1e-9 and len(full) < len(names):
        open_ = [s for s in names if s not in full]
        unit = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in open_:
            target[s] += unit * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                full.add(s)
    return target


def test_mixing(docs, no_docs):
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in hard_rows():
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    target = slow_targets(sizes)
    assert len(rows) == len(hard_rows())
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    least = {s: min((r["size"] for r in rows if r["source"] == s and r["size"]), default=0) for s in sizes}
    for s in sizes:
        # a document that holds most of its source leaves a gap that the rest, each at most twice, can't fill
        large = max(r["size"] for r in rows if r["source"] == s)
        gap = min(max(c * large - target[s], target[s] - c * large - 2 * (sizes[s] - large), 0) for c in (0, 1, 2))
        assert abs(taken[s] - target[s]) <= gap + max(least[s], 0.02 * target[s])
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.mix(no_docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3, 7, 11, 19])
def test_mixing_meets_every_target(spark, seed):
    """Each source within 2 % of its target or within its smallest document, although some hold one document of a third of their words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs, seed=seed).collect()
    by = {}
    for r in rows:
        assert r["copies"] * r["size"] <= 2 * r["size"]
        x = by.setdefault(r["source"], [0, r["target"], 10 ** 9])
        x[0] += r["copies"] * r["size"]
        if r["size"]:
            x[2] = min(x[2], r["size"])
    assert len(by) > 10
    for taken, target, least in by.values():
        assert abs(taken - target) <= max(0.02 * target, least)


def test_large_documents_keep_their_expectation(spark):
    """A document of a third of its source is copied as often as its rate says, over many sources and seeds."""
    rows = [(f"s{s:02}" if s else None, i, " ".join(["w"] * (400 if i == 0 else 8)), f"s{s}") for s in range(60) for i in range(100)]
    docs = spark.createDataFrame([(s * 1000 + i, t, src) for s in range(60) for src, i, t, _ in rows[s * 100:s * 100 + 100]], "doc_id long, text string, source string")
    share, hits = 0.7, []
    for seed in range(4):
        got = mixing.mix(docs, share=share, weights=(1.0,), seed=seed).collect()
        hits += [r["copies"] for r in got if r["size"] == 400]
        taken = Counter()
        for r in got:
            taken[r["source"]] += r["copies"] * r["size"]
        assert all(abs(n - share * (400 + 99 * 8)) <= 8 for n in taken.values())
    assert len(hits) == 240 and abs(np.mean(hits) - share) < 0.12


def test_pivotal_rounding_over_many_levels(spark):
    """Sums are kept to one document and every document's probability in expectation."""
    n = 300
    items = spark.range(n).select(F.lit("s").alias("source"), F.lit(n).alias("docs"), F.col("id").alias("doc_id"), F.col("id").alias("key"),
                                  F.lit(1).alias("n"), (1 + F.col("id") % 7).cast("long").alias("size"), F.lit(0).cast("long").alias("base"), F.lit(0.3).alias("p"))
    expected, hits = 0.3 * sum(1 + i % 7 for i in range(n)), np.zeros(n)
    seeds = range(8)
    for seed in seeds:
        got = mixing.pivotal_round(items, seed, fan_in=8).collect()
        assert sorted(r["doc_id"] for r in got) == list(range(n))
        assert abs(sum(r["copies"] * r["size"] for r in got) - expected) <= 7
        for r in got:
            hits[r["doc_id"]] += r["copies"]
    assert abs(hits.mean() / len(seeds) - 0.3) < 0.03 and abs(hits[:n // 2].mean() - hits[n // 2:].mean()) < 0.5


# --- chat -------------------------------------------------------------------------

CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|turn|>", "<|text|>", "<", "[", "\\", "|", ">", "INST]", "/s>", "a", "é", "\n", " "]


def test_chat_round_trip(spark):
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "</s>", None]), "".join(rnd.choice(CONTROL) for _ in range(rnd.randint(0, 9))) or None)
            for c in [*range(60), None] for t in range(rnd.randint(1, 4))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_parts(F.col("text")))
    out = chat.format_conversations(df.withColumn("formatted", F.lit("clash")))
    out = out.select("conv_id", "n_turns", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                     chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    got = {r["conv_id"]: r for r in out.collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        assert [(x["role"], x["content"]) for x in got[c]["turns"]] == [x[1:] for x in sorted(turns)]
        assert got[c]["loss"] == "".join(x[2] for x in sorted(turns) if x[1] == "assistant")
        assert got[c]["formatted"].count("</s>") == got[c]["n_turns"] == len(turns)
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_typed_parts(spark):
    part = "struct<type:string,text:string,ref:string,units:bigint>"
    df = spark.createDataFrame([
        (1, 0, "user", [("text", "see <|image:0|> ", None, None), ("image", None, "i.png", 1568), ("audio", None, "a.wav", 81)]),
        (1, 1, "assistant", [("text", "ok", None, None), ("document", None, "d.pdf", 3), ("video?", None, None, None)]), (2, 0, "user", None)],
        f"conv_id long, turn long, role string, parts array<{part}>")
    r = {x["conv_id"]: x for x in chat.format_conversations(df).collect()}
    assert r[1]["formatted"] == ("<|turn|>user<|text|>see <\\|image:0|> <|image:0|><|audio:1|></s>"
                                 "<|turn|>assistant<|text|>ok<|document:2|><|video_:3|></s>")
    assert [tuple(a) for a in r[1]["attachments"]] == [(0, 0, "image", "i.png", 2), (1, 0, "audio", "a.wav", 3), (2, 1, "document", "d.pdf", 1536), (3, 1, "video?", None, 0)]
    assert r[1]["expanded_tokens"] == 1541 and r[2]["formatted"] == "<|turn|>user<|text|></s>"


def test_long_conversation(spark):
    """Thousands of turns, with attachments counted through all of them, in time that grows with the turns."""
    import time

    part = f"array<{chat.PART}>"

    def formatted(n):
        rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                     F.expr(f"array(struct('text' AS type, concat('turn ', id) AS text, null AS ref, 0L AS units), "
                                            f"struct('image' AS type, null AS text, concat('i', id) AS ref, 784L AS units))").cast(part).alias("parts"))
        began = time.monotonic()
        (r,) = chat.format_conversations(rows).collect()
        return r, time.monotonic() - began

    formatted(10)
    r, short = formatted(2000)
    assert r["formatted"] == "".join(f"<|turn|>{'assistant' if i % 2 else 'user'}<|text|>turn {i}<|image:{i}|></s>" for i in range(2000))
    assert [r["formatted"][s["from"]:s["to"]] for s in r["loss_spans"]] == [f"turn {i}<|image:{i}|>" for i in range(1, 2000, 2)]
    assert [tuple(a) for a in r["attachments"]] == [(i, i, "image", f"i{i}", 1) for i in range(2000)] and r["expanded_tokens"] == 2000
    _, long = formatted(20_000)
    assert long < 20 * max(short, 0.3)


def test_chat_query_digests(spark):
    from tessera.llm.queries import op9_chat_format

    got = {r["conv_id"]: r for r in op9_chat_format(spark, "/root/testdata/sf0.001").collect()}
    text = "</s>[INST] ok [/INST]"
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (got[-7]["loss_chars"], got[-7]["loss_sha256"]) == (len(text), hashlib.sha256(text.encode()).hexdigest())
