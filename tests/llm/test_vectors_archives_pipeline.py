"""Vector search, graph near-duplicates, archives and the pipeline against brute force."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import ann_dedup, va_search, warc
from tessera.llm.common import connected_components
from tests.llm.conftest import DOC_SCHEMA, EN, FR, doc
from tests.llm.test_text_operators import slow_components, slow_fingerprint, slow_targets

SCHEMA = "vec_id long, embedding array<float>, label int, v string, block string, node string"


def vectors():
    rnd = np.random.default_rng(6)
    rows = []
    for c in range(12):
        base = rnd.normal(size=16)
        for _ in range(15):
            rows.append((base + rnd.normal(size=16) * rnd.choice([0.02, 0.08, 1.0])).astype(np.float32).tolist())
    rows += [rows[0], rows[0], rows[3]]                               # exact copies
    out = [(i, v, i % 3, "x", "x", "x") for i, v in enumerate(rows)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    out += [(1000 + 50 * i, v, None, "x", "x", "x") for i, v in enumerate(bad)]
    return out + [out[5], (None, rows[1], 0, "x", "x", "x")]          # a repeated row, a null id


def test_va_search(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    own = {i: [int(np.floor(256 * float(x))) for x in v] for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    for size, query_size in ((8192, 512), (20, 2)):                   # one block; many blocks of each
        got = {}
        for r in va_search.top_k(df, df.where("vec_id % 50 = 0"), rows=size, query_rows=query_size).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        want = {}
        for q in own:
            if q % 50 == 0:
                best = sorted((-sum(a * b for a, b in zip(own[q], v)), i) for i, v in own.items() if i != q and len(v) == len(own[q]))[:5]
                if best:
                    want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
        assert {q: sorted(x) for q, x in got.items()} == want
    assert va_search.top_k(df.limit(0), df).count() == 0


def test_va_ties_and_large_components(spark):
    rows = [(i, [float(1 + i // 200), 0.5]) for i in range(600)] + [(1000, [3e7, 1e9]), (1050, [-3e7, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    got = {}
    for r in va_search.top_k(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, found in got.items():
        best = sorted((-sum(a * b for a, b in zip(own[q], v)), i) for i, v in own.items() if i != q)[:5]
        assert sorted(found) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_graph_near_duplicates(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["vec_id"]: r for r in ann_dedup.near_duplicates(df).collect()}
    usable = {i: np.array(v, np.float64) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    assert set(got) == {r[0] for r in rows if r[0] is not None}
    unit = {i: v / np.linalg.norm(v) for i, v in usable.items()}
    links = {(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95}
    n = {i: 0 for i in got}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert all(got[i]["n_links"] <= n[i] for i in n)                  # nothing below the threshold
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * sum(n.values()) > 100
    assert got[1000]["kept"] and got[1000]["n_links"] == 0
    assert got[180]["component_id"] == 0 and not got[180]["kept"]     # a copy of row 0
    assert got[0]["audit_found"] >= 0.9 * got[0]["audit_true"]
    assert ann_dedup.near_duplicates(df.limit(0)).count() == 0


def test_large_shards_are_dealt_to_pairs(spark):
    """All pairs of a shard meet in some task."""
    df = spark.createDataFrame([(i, [1.0, i / 1000]) for i in range(90)], "vec_id long, v array<double>")
    tasks = ann_dedup.shards(df, shard=1000, largest=20).collect()
    by = {}
    for r in tasks:
        by.setdefault((r["pivot"], r["i"], r["j"]), set()).add(r["vec_id"])
    assert max(map(len, by.values())) < 70
    assert all(any(a in x and b in x for x in by.values()) for a in range(90) for b in range(a))


def test_connected_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {}

    def find(a):
        while label.setdefault(a, a) != a:
            a = label[a]
        return a

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            label[y] = x
    assert got == {a: find(a) for a in list(label)}


def test_loser_tree():
    rnd = random.Random(9)
    for k in range(9):
        runs = [sorted(rnd.randrange(30) for _ in range(rnd.randrange(12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: (x,))) == sorted(x for r in runs for x in r)


def pages():
    big = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 80
    rows = [(i, f"http://www.H{i % 4}.example.com/p?q={i % 3}#f", f"<html>{i}</html>") for i in range(40)]
    rows += [(50, "http://a.org/x", big), (51, "http://a.org/x", big), (52, None, big), (53, "bad\r\nurl", big + "!"), (None, "http://a.org/x", big),
             (54, "http://a.org/y", None), (55, "http://a.org/y", ""), (51, "http://a.org/z", big), (30, "http://h1.example.com/", "small"), (31, "x", "small")]
    return rows


def test_warc_archives_and_index(spark, tmp_dir):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, last string, n string")
    warc.write_archives(df, f"{tmp_dir}/w")
    got = warc.merged_index(warc.read_runs(spark, f"{tmp_dir}/w")).collect()
    last = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            last[data] = max(last.get(data, i), i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        ref = last.get(data) if last.get(data) != i else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if ref is not None else "response", ref))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == sorted(want, key=str)
    keys = [warc._rank((r["url_key"], r["captured"], r["page_id"])) for r in sorted(got, key=lambda r: (r["index_range"], r["index_place"]))]
    assert keys == sorted(keys)
    assert {r["url_key"] for r in got} >= {"org,a)/x", "com,example,h1)/p?q=1", ""}
    warc.write_archives(df.limit(0), f"{tmp_dir}/e")
    assert warc.merged_index(warc.read_runs(spark, f"{tmp_dir}/e")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as pipe

    rows = [doc(i, (EN if i % 2 else FR) * (2 + i % 5) + f"Item {i} closes the list of number {i * 7919}.", "en" if i % 2 else "fr", "ab"[i % 2]) for i in range(60)]
    rows += [doc(100, rows[3][1], "en", "a"), doc(101, "12 34 --", None, "a"), doc(102, None, "en", "b"), rows[4], doc(None, FR * 7, "fr", None)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    kept = pipe.language(spark, docs, "").collect()
    assert sorted(map(str, kept)) == sorted(str(tuple(r[:5])).join(["", ""]) and str(spark_row(r)) for r in rows if r[0] not in (101, 102))
    left = spark.createDataFrame(kept, docs.select(*pipe.COLUMNS).schema)
    unique = pipe.near_dedup(spark, left, "").collect()
    part = slow_components([slow_fingerprint(r["text"]) for r in kept])
    groups = {}
    for r, p in zip(kept, part):
        groups.setdefault(p, []).append(r["doc_id"])
    want = sorted(str(min((i for i in g if i is not None), default=None)) for g in groups.values())
    assert sorted(str(r["doc_id"]) for r in unique) == want
    mixed = pipe.mixing(spark, spark.createDataFrame(unique, left.schema), "").collect()
    sizes, taken = {}, {}
    for rows_, total in ((unique, sizes), (mixed, taken)):
        for r in rows_:
            total[r["source"]] = total.get(r["source"], 0) + len(r["text"].split())
    target = slow_targets(sizes)
    assert all(abs(taken.get(s, 0) - target[s]) <= 120 for s in sizes)
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in unique}
    pieces = pipe.packing(spark, spark.createDataFrame(mixed, left.schema), "")
    assert pieces.where("start = 0").count() == len(mixed)
    empty = docs.limit(0)
    for _, stage in pipe.STAGES:
        assert stage(spark, empty, "").count() == 0


def brute_chain(rows):
    """What each stage must keep of ``rows`` (dicts): language ID by the operator's predictions, then plain code."""
    part = slow_components([slow_fingerprint(r["text"]) for r in rows])
    groups = {}
    for r, p in zip(rows, part):
        groups.setdefault(p, []).append(r)
    unique = [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]
    sizes = {}
    for r in unique:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    return unique, slow_targets(sizes)


def test_pipeline_run_against_a_brute_force_chain(spark, tmp_dir):
    """run() over a written table: every stage written and reread; all pieces of the last are put together again."""
    import numpy as np
    from tokenizers import Tokenizer

    import corpus_pipeline as pipe
    from tessera.llm.queries import vocabulary

    rnd = random.Random(12)
    words = [(EN + FR).split(), FR.split()]
    rows = []
    for i in range(140):
        lang = "en" if i % 2 else "fr"
        rows.append(doc(i, " ".join(rnd.choice(words[i % 2 == 0]) + str(rnd.randint(0, 99)) for _ in range(rnd.choice([40, 90, 400]))), lang, "abc"[i % 3]))
    rows += [doc(200 + k, rows[k][1], rows[k][2], "a") for k in (3, 3, 8)]                      # exact copies
    rows += [doc(210 + k, rows[k][1] + " end", rows[k][2], "b") for k in (5, 20, 47)]          # near copies
    gone = [doc(300, "12 34 -- ½", None, "a"), doc(301, None, "en", "b"), doc(302, "", "fr", None)]
    spark.createDataFrame(rows + gone, DOC_SCHEMA).repartition(4).write.parquet(f"{tmp_dir}/documents.parquet")
    pieces = pipe.run(spark, tmp_dir).collect()
    unique, target = brute_chain([dict(doc_id=r[0], text=r[1], source=r[3]) for r in rows])
    assert len(unique) < len(rows)
    # pieces follow each other in their sequences without a gap; a document's pieces follow each other in the stream
    ordered = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    filled, documents = {}, []
    for p in ordered:
        assert p["offset"] == filled.get(p["sequence_id"], 0)
        filled[p["sequence_id"]] = p["offset"] + p["length"]
        ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert len(ids) == p["length"]
        if p["start"] == 0:
            documents.append((p["doc_id"], []))
        assert documents[-1][0] == p["doc_id"] and len(documents[-1][1]) == p["start"]
        documents[-1][1].extend(ids)
        if p["start"] + p["length"] == p["doc_tokens"]:
            assert len(documents[-1][1]) == p["doc_tokens"]
    assert max(filled.values()) <= 1024 and len(pieces) == len({(p["sequence_id"], p["offset"]) for p in pieces})
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    by = {r["doc_id"]: r for r in unique}
    taken = {}
    for name, ids in documents:
        assert ids == tok.encode(by[name]["text"], add_special_tokens=False).ids + [0]
        taken[by[name]["source"]] = taken.get(by[name]["source"], 0) + len(by[name]["text"].split())
    copies = {}
    for name, _ in documents:
        copies[name] = copies.get(name, 0) + 1
    assert max(copies.values()) <= 2
    for s, want in target.items():
        least = min(len(r["text"].split()) for r in unique if r["source"] == s)
        assert abs(taken.get(s, 0) - want) <= max(least, 0.02 * want)


def test_pipeline_language_rejects_on_evidence_only(spark):
    """Short clean texts and labels with few or only held-out rows stay; long random letters go."""
    import corpus_pipeline as pipe

    rnd = random.Random(3)
    held = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 4 == 2]
    free = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [doc(free.pop(), (EN if i % 2 else FR) * 3 + f"Number {i}.", "en" if i % 2 else "fr", "a") for i in range(40)]
    rows += [doc(free.pop(), t, "en", "a") for t in ("ok", "Zoë", "Xylqz", "QWJKX", "Žižek", "GmbH")]
    rows += [doc(held.pop(), t, "en", "a") for t in ("ok", "Ömer", "Kvapil", "XBOX")]
    tamil = "யாமறிந்த மொழிகளிலே தமிழ்மொழி போல் இனிதாவது எங்கும் காணோம் " * 3
    greek = "Η γρήγορη αλεπού πηδά πάνω από το τεμπέλικο σκυλί και φεύγει από το παλιό σπίτι. "
    rows += [doc(held.pop(), tamil, "ta", "b"), doc(held.pop(), "தமிழ்", "ta", "b"), doc(free.pop(), greek, "el", "b"),
             doc(held.pop(), "Το παλιό σπίτι είναι πάνω από τη θάλασσα και ο σκύλος τρέχει γρήγορα προς την πόλη.", "el", "b")]
    rows += [doc(held.pop(), EN[:44] + "Zj9Kv2Wq8Xb4Yp6" * 12, "en", "a")]      # a sentence with a key in it
    used = "".join(sorted(set(EN + FR + "".join(str(i) for i in range(10))) - {" "}))
    noise = [doc(held.pop(), "".join(rnd.choice(used) for _ in range(n)), None, "b") for n in (200, 3000)]
    noise += [doc(held.pop(), " ".join("".join(rnd.choice(used) for _ in range(12)) for _ in range(40)), None, "b")]
    found = pipe.language(spark, spark.createDataFrame(rows + noise, DOC_SCHEMA), "").collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    # nothing to learn from
    bare = spark.createDataFrame([doc(1, EN, None, "a"), doc(2, "12 34", None, "a")], DOC_SCHEMA)
    assert [r["doc_id"] for r in pipe.language(spark, bare, "").collect()] == [1]


def test_pipeline_dedup_without_ids(spark):
    """Near copies without doc_ids give one document; components that share a repeated doc_id stay apart."""
    import corpus_pipeline as pipe

    rnd = random.Random(11)
    words = [" ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)) for _ in range(2)]
    rows = [doc(None, words[0] + end, "en", "a") for end in ("", " one", " two", " three")] + [doc(5, words[1], "en", "a"), doc(5, EN * 3, "en", "a")]
    fps = [slow_fingerprint(r[1]) for r in rows]
    part = slow_components(fps)
    assert len(set(fps[:4])) > 1 and len(set(part)) == 3                # linked, but not equal
    got = pipe.near_dedup(spark, spark.createDataFrame(rows, DOC_SCHEMA), "").collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["5", "5", "None"]


def spark_row(r):
    from pyspark.sql import Row

    return Row(doc_id=r[0], text=r[1], lang=r[2], source=r[3], n_chars=r[4])


def test_components_have_no_cross_join(spark, docs):
    """The join of SimHash cells is an equi-join."""
    import contextlib
    import io

    from tessera.llm import simhash

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        simhash.links(docs.select(F.col("doc_id").alias("fp"))).explain()
    assert "Cartesian" not in out.getvalue() and "NestedLoop" not in out.getvalue()


def test_each_pair_of_overlapping_tasks_is_counted_once(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, (rnd.normal(size=6) * 0.3 + np.eye(6)[i % 6]).tolist()) for i in range(300)]
    table = ann_dedup.shards(spark.createDataFrame(rows, "vec_id long, v array<double>"), shard=40, largest=25).toPandas()
    met, counted = set(), {}
    for (_, pivot, i, j), task in table.groupby(["dim", "pivot", "i", "j"]):
        ids = task["vec_id"].to_numpy()
        own = ann_dedup.own_pairs(np.stack(task["pivots"]), task["sub"].to_numpy(), pivot, i, j)
        met |= {(a, b) for a in ids for b in ids if a < b}
        for a, b in zip(*np.nonzero(own)):
            if ids[a] < ids[b]:
                counted[ids[a], ids[b]] = counted.get((ids[a], ids[b]), 0) + 1
    assert set(counted) == met and set(counted.values()) == {1}


def test_many_vector_lengths(spark):
    """70 lengths, more than get pivots: links within each are found, none between them."""
    rnd = np.random.default_rng(8)
    rows = []
    for k, dim in enumerate(range(2, 72)):
        base = rnd.normal(size=dim)
        rows += [(10 * k + j, (base * (1 + j) + (0 if j < 3 else 50 * rnd.normal(size=dim))).tolist()) for j in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ann_dedup.near_duplicates(df).collect()}
    by = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    label = {i: i for i in by}
    links = {i: [j for j in by if j != i and len(by[j]) == len(by[i]) and by[i] @ by[j] >= 0.95] for i in by}
    for _ in range(5):
        for i, near in links.items():
            label[i] = min([label[i], *(label[j] for j in near)])
    assert got == {i: (len(links[i]), label[i]) for i in by}
    assert sum(len(x) for x in links.values()) >= 70 * 6


def test_group_of_near_copies_gives_rows_in_proportion(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=16)
    rows = [(i, (base + rnd.normal(size=16) * 0.03).tolist(), 1) for i in range(300)]
    nodes = spark.createDataFrame(rows, "vec_id long, v array<double>, copies int")
    found = ann_dedup.links(nodes, 0.95)
    assert found.count() < 4 * 300                                    # of 44,850 links
    got = {r["vec_id"]: r for r in ann_dedup.near_duplicates(nodes, vector_col="v").collect()}
    assert all(r["n_links"] == 299 and r["component_id"] == 0 for r in got.values())


def test_va_bounds_hold_and_save_reads(spark):
    """Stored cells bound every component; the exact vectors read are a small part of all."""
    rnd = np.random.default_rng(9)
    for bits in (2, 4, 7):
        exact = np.floor(rnd.normal(size=(301, 5)) * 100)
        cells, ends = va_search.cells_of(exact, bits)
        assert len(cells) == (-(-301 * 5 // 2) if bits <= 4 else 301 * 5)
        low, high = va_search.bounds_of(cells, ends, 301, 5, bits)
        assert (low <= exact).all() and (exact <= high).all()
    x = np.floor(rnd.normal(size=(200, 5)) * 50)
    low, high = va_search.bounds_of(*va_search.cells_of(x), 200, 5)
    (first, least, most), = va_search.bounds(x[:7], np.arange(7), low, high, np.arange(200))
    lows, tops = va_search.scan_block(x[:7], np.arange(7), low, high, np.arange(200), 3)
    for a in range(7):
        others = [b for b in range(200) if b != a]
        scores = x[others] @ x[a]
        assert (least[a, others] <= scores).all() and (scores <= most[a, others]).all() and least[a, a] == most[a, a] == -np.inf
        assert sorted(lows[a]) == sorted(least[a, others])[-3:] and tops[a] == most[a].max()
        assert min(lows[a]) <= sorted(scores)[-3]                    # the limit never cuts off a result
    centres = rnd.normal(size=(40, 32))
    rows = [(i, (centres[i % 40] + rnd.normal(size=32) * 0.2).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = va_search.top_k(df, df.where("vec_id % 50 = 0"), rows=500, query_rows=16, counts=True).collect()
    assert len(got) == 5 * 80
    read = {r["query_id"]: r["exact_read"] for r in got}
    assert sum(read.values()) < 0.1 * 4000 * 80


def test_va_reads_exact_vectors_only_for_candidates(spark):
    """The scan's plan reads cells, not exact vectors; these are joined to candidates."""
    import contextlib
    import io

    df = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(300)], "vec_id long, embedding array<double>")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        va_search.top_k(df, df.where("vec_id % 50 = 0"), rows=50, query_rows=2).explain()
    plan = out.getvalue()
    assert plan.count("MapInArrow") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan
    # the scan of cells is done and written; what is left reads its candidates, and the blocks they stand in
    assert plan.count("ids:binary,data:binary") == 1 and plan.count("cells:binary") == 1
