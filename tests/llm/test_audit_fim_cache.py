"""Filter audit, fill-in-the-middle and token counts against plain versions."""

import hashlib
import random
import re
from collections import Counter as Bag
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tessera.llm import filter_audit, fim, token_cache
from tessera.llm.common import materialise, spread_join
from tessera.llm.queries import vocabulary
from tests.llm.conftest import CLASHING, DOC_SCHEMA, EN, doc, hard_rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BYTE, WORD, PIECE = (vocabulary(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


# --- joins with hot keys ----------------------------------------------------------

def test_spread_join(spark):
    rows = [(7, i) for i in range(900)] + [(None, i) for i in range(300)] + [(i, i) for i in range(40, 200)] * 2 + [(8, i) for i in range(400)]
    values = {7: "hot", **{i: f"v{i}" for i in range(40, 120)}, 500: "unused"}
    left = materialise(spark.createDataFrame(rows, "k long, i long"), "t")
    right = spark.createDataFrame(list(values.items()), "k long, v string")
    got = spread_join(left, right, "k")
    assert got.columns == ["k", "i", "v"]
    assert Bag(tuple(r) for r in got.collect()) == Bag((k, i, values.get(k)) for k, i in rows)
    assert spread_join(materialise(left.limit(0), "t"), right, "k").count() == 0


# --- filter audit -----------------------------------------------------------------

def slow_audit(rows, filters):
    """``rows``: (part, set of failed letters, good, toxic)."""
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = Bag()
        for order in permutations(filters):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                fails = [r for r in own if letter in r[1]]
                out[part, "".join(order), step] = (len(left), len(gone), len(fails) - len(gone), sum(r[1] == {letter} for r in own),
                                                   sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[letter] += len(gone)
        for (p, order, step), x in list(out.items()):
            if p == part:
                out[p, order, step] = (*x[:6], shapley[order[step - 1]])
    return out


def as_dict(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in df.collect()}
    assert len(found) == df.count()
    return found


def test_audit_of_documents(spark, docs, no_docs):
    rows = hard_rows() + [doc(60, EN * 60, "en", "a"), doc(61, "A B C #", "en"), doc(62, "A B C #", ""), doc(-5, "A B C #", None), doc(63, None, "zz")]
    table = spark.createDataFrame(rows, DOC_SCHEMA)
    marks = [(0, 1, 0), (0, 0, 1), (60, None, 1), (5, 1, None), (61, 1, 1), (None, 1, 1), (999, 1, 1), (61, 1, 1), (63, 0, 0)]
    labels = spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, toxic int, part string")
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    plain = []
    for i, text, lang, *_ in rows:
        t = text or ""
        w = WORDS.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        own = [m for m in marks if m[0] == i and i is not None]
        plain.append((lang or "", {k for k, v in fails.items() if v}, any(m[1] == 1 for m in own), any(m[2] == 1 for m in own)))
    got = filter_audit.audit(filter_audit.checked(table, labels))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert as_dict(got) == slow_audit(plain, "ABCDE")
    assert filter_audit.audit(filter_audit.checked(no_docs, labels)).count() == 0
    assert as_dict(filter_audit.audit(filter_audit.checked(docs, labels.limit(0))))


def test_audit_over_ranges_and_other_filters(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(rnd.choice(["en", "en", "en", "fr", ""]), {x for x in "XYZ" if rnd.random() < 0.4}, rnd.random() < 0.5, rnd.random() < 0.1) for _ in range(3000)]
    rows += [("clean", set(), True, True)] * 3
    df = spark.createDataFrame([(p, sum(1 << "XYZ".index(x) for x in f), g, t) for p, f, g, t in rows], "part string, fails int, good boolean, toxic boolean")
    monkeypatch.setattr(filter_audit, "RANGE", 5)
    assert as_dict(filter_audit.audit(df, "XYZ")) == slow_audit(rows, "XYZ")
    lists = filter_audit.posting_lists(df, "XYZ").collect()
    assert all(x["ids"] == sorted(set(x["ids"])) and len(x["ids"]) <= 32 for x in lists) and len({x["range"] for x in lists}) > 50
    with pytest.raises(ValueError):
        filter_audit.audit(df, "XX")


def test_gallop_and_merged_runs():
    rnd = random.Random(1)
    for _ in range(300):
        ids = sorted(rnd.sample(range(200), rnd.randint(1, 60)))
        low = rnd.randrange(len(ids))
        x = rnd.randint(ids[low], 210)
        assert filter_audit.gallop(ids, low, x) == next((i for i in range(low, len(ids)) if ids[i] >= x), len(ids))
        lists = [sorted(rnd.sample(range(80), rnd.choice([0, 3, 40]))) for _ in range(5)]
        sizes = Bag()
        for held, n in filter_audit.merged_runs(lists):
            sizes[held] += n
        assert sizes == Bag(sum(1 << i for i, one in enumerate(lists) if x in one) for x in set().union(*lists))
    # a long list beside a short one is passed in few steps
    assert len(list(filter_audit.merged_runs([list(range(10 ** 5)), [50_000]]))) == 3


# --- fill in the middle -----------------------------------------------------------

def test_unit_ends():
    whole, words = fim.unit_pattern(), fim.unit_pattern(r"\S+\s*")
    for text in ("", "a", "é\n😀\r\n\0", EN * 3):
        assert fim.unit_ends(whole, text).tolist() == list(range(1, len(text) + 1))
    assert fim.unit_ends(words, "one two  three").tolist() == [4, 9, 14]
    assert fim.unit_ends(words, " one") is None
    rnd = random.Random(2)
    for _ in range(200):                         # windows give what one match gives
        text = "".join(rnd.choice("ab  \né") for _ in range(rnd.randint(0, 60))).lstrip()
        for p in (whole, words):
            assert fim.unit_ends(p, text, window=rnd.choice([1, 3, 7])).tolist() == fim.unit_ends(p, text).tolist()
    assert fim.unit_ends(words, " x y z", window=2) is None and fim.unit_ends(words, "x" * 500, window=2).tolist() == [500]
    for bad in ("(a)", "a*"):
        with pytest.raises(ValueError):
            fim.unit_pattern(bad)


def test_very_long_text_in_windows():
    text = "aé\n" * 400_000
    ends = fim.unit_ends(fim.unit_pattern(), text)
    assert len(ends) == len(text) == ends[-1]


def test_markers_that_overlap_are_refused():
    for bad in (("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "ba", "x"), ("aa", "b", "c"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            fim.check_markers(bad)
    fim.check_markers(fim.MARKERS)


def test_fill_in_middle(spark, no_docs):
    rnd = random.Random(3)
    rows = hard_rows() + [doc(100 + i, "".join(rnd.choice(["a", "é", "😀", " ", "\n", "<", "P>", "<P", "\\", "$1"]) for _ in range(rnd.randint(1, 30))))
                          for i in range(300)] + [doc(900, "has <S> in it"), doc(901, "<M>"), doc(902, "x")]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = fim.fill_in_middle(docs, keep=("doc_id", "text", *CLASHING)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert Bag((r["row"]["doc_id"], r["row"]["text"]) for r in got) == Bag((r[0], r[1]) for r in rows)
    forms = Bag()
    for r in got:
        t = r["row"]["text"] or ""
        h = hashlib.sha256(f"1:{'' if r['row']['doc_id'] is None else r['row']['doc_id']}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
        n = len(t)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        pre, mid, suf = t[:a], t[a:b], t[b:]
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            want = ("plain", None, None, t)
        elif h4 % 100 < 20:
            want = ("spm", a, b, f"<S>{suf}<P>{pre}<M>{mid}")
        else:
            want = ("psm", a, b, f"<P>{pre}<S>{suf}<M>{mid}")
        assert (r["n"], r["form"], r["prefix_end"], r["middle_end"], r["output"], r["back"]) == (n, *want, t)
        assert all(r["row"][c] == "x" for c in CLASHING)
        forms[r["form"]] += 1
    assert len(forms) == 3
    assert fim.fill_in_middle(no_docs).count() == 0


def test_fill_in_middle_of_words(spark):
    docs = spark.createDataFrame([(i, f"w{i} and  some\nmore words of {i}") for i in range(60)] + [(99, " starts with a space")], "doc_id long, text string")
    got = fim.fill_in_middle(docs, keep=("doc_id", "text"), unit=r"\S+\s*", markers=("[pre]", "[suf]", "[mid]"), rate=100, spm=50)
    for r in got.withColumn("back", fim.restored(F.col("output"), F.col("form"), ("[pre]", "[suf]", "[mid]"))).collect():
        text = r["row"]["text"]
        assert r["back"] == text
        if r["row"]["doc_id"] == 99:
            assert (r["n"], r["form"]) == (None, "plain")
            continue
        assert r["n"] == 7 and r["form"] in ("psm", "spm")
        assert all(x in (0, len(text)) or text[x - 1].isspace() and not text[x].isspace() for x in (r["prefix_end"], r["middle_end"]))


# --- token cache ------------------------------------------------------------------

def plain_counts(path, texts):
    texts = [t or "" for t in texts]
    if path.endswith(".json"):
        return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    return [len(x) for x in SentencePieceProcessor(model_file=path).encode(texts)]


SPECIAL = [doc(70, "a <|endoftext|> b"), doc(71, "<|ENDOFTEXT|>"), doc(72, "Café  au lait"), doc(73, "Café au LAIT"), doc(74, "<|startoftext|>A\n\nA"),
           doc(75, "a <s> b </s>"), doc(76, "ﬁne 　 x"), doc(77, "fine x")]


@pytest.mark.parametrize("path", [BYTE, WORD, PIECE])
def test_token_cache(spark, no_docs, tmp_dir, path, monkeypatch):
    rows = hard_rows() + SPECIAL + [doc(200 + i, EN * 5) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    cache = f"{tmp_dir}/cache"
    want = Bag((r[0], len((r[1] or "").encode()), n) for r, n in zip(rows, plain_counts(path, [r[1] for r in rows])))

    def counted(df):
        got = token_cache.count_tokens(df, path, cache, keep=("doc_id", "text", *CLASHING)).collect()
        return Bag((r["row"]["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got)

    def stored():
        return spark.read.schema(token_cache.SCHEMA).parquet(cache)

    assert token_cache.count_tokens(no_docs, path, cache).count() == 0 and stored().count() == 0
    some = docs.where("doc_id < 30 or doc_id is null")
    assert counted(some) == Bag({k: v for k, v in want.items() if k[0] is None or k[0] < 30})
    own = token_cache.Counter(path)
    distinct = {own.digest(r[1] or "") for r in rows}
    before = stored().count()
    assert 0 < before < len(distinct) <= len({r[1] or "" for r in rows})
    # only misses are encoded, once each, whichever way texts meet them
    monkeypatch.setattr(token_cache, "BROADCAST", 0)
    assert counted(docs) == want
    assert stored().count() == stored().select("content").distinct().count() == len(distinct)
    monkeypatch.setattr(token_cache, "encoded", None)            # everything is known now
    assert counted(docs) == want
    # rows stored twice do no harm
    materialise(stored(), "t").write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert counted(docs) == want


def test_token_cache_keeps_versions_apart(spark, tmp_dir, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three"), (2, "Four")], "doc_id long, text string")
    cache = f"{tmp_dir}/cache"
    for path in (BYTE, WORD, PIECE):
        got = {r["row"]["doc_id"]: r["n_tokens"] for r in token_cache.count_tokens(docs, path, cache).collect()}
        assert list(got[i] for i in (1, 2)) == plain_counts(path, ["one two three", "Four"])
    found = spark.read.schema(token_cache.SCHEMA).parquet(cache)
    assert found.count() == 6 and found.select("tokenizer").distinct().count() == 3
    old = token_cache.tokenizer_version(BYTE)
    monkeypatch.setattr(token_cache, "library_version", lambda name: "0")
    assert token_cache.tokenizer_version(BYTE) != old


def test_slices():
    assert list(token_cache.slices([])) == []
    assert list(token_cache.slices(["aaaa", "b", "c" * 9, "d"], most=5)) == [(0, 2), (2, 3), (3, 4)]


def test_queries(spark):
    from tessera.llm.queries import op12_fill_in_middle, op13_token_cache

    d = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    cut = op12_fill_in_middle(spark, d).collect()
    assert {r["doc_id"]: r["restored_sha256"] for r in cut} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows.items()}
    assert all((r["form"] == "plain") == (r["prefix_chars"] is None) == (r["middle_chars"] is None) for r in cut)
    n = dict(zip(rows, plain_counts(BYTE, rows.values())))
    assert {tuple(r) for r in op13_token_cache(spark, d).collect()} == {(i, len(t.encode()), n[i], n[i] > 1024) for i, t in rows.items()}
