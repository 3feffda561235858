"""Text operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from seqcat.llm import chat, decontaminate, exact_dedup, lm_scoring, mixing, near_dedup, queries, sharding, substrings, token_counts, toxicity
from seqcat.llm.graph import components
from seqcat.llm.queries import _tokenizer
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int"
R = random.Random(5)
VOCAB = ["w%d" % i for i in range(300)]


def prose(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


LONG = prose(20000)
BASE = prose(120)
ODD = [None, "", "   ", "one", "A b\tc\n d", "a b c d e", "É ñ 中 👍 x", LONG, BASE, BASE.upper(), BASE + " tail", prose(70) + " " + BASE,
       prose(60), "<|endoftext|> hi  there\n\n x's", "A b\tc\n d"]


def rows_of(texts):
    out = [(i, t, "en", ["s0", "s1", None][i % 3], None, 1, 2) for i, t in enumerate(texts)]
    return [*out, out[3], (None, "null id text", None, None, None, None, None), (None, None, None, "s1", None, None, None)]


ROWS = rows_of(ODD + [prose(R.randint(1, 90)) for _ in range(60)])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())


def test_sharding(docs, empty):
    out = sharding.op1_sharding(docs.sparkSession, docs).collect()
    assert len(out) == len(ROWS)
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, *_ in ROWS)
    for s in range(24):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert sharding.op1_sharding(docs.sparkSession, empty).count() == 0


def test_rebalanced_map_is_even_and_edits_little(spark):
    rows = spark.range(20000).select((F.col("id") % 512).cast("int").alias("vslot"), (F.col("id") % 97).alias("size"))
    sizes = sharding.slot_sizes(rows, 512).cache()
    old = sharding.first_map(spark, 10, 512)
    new = sharding.rebalanced(old, sizes, 10).cache()
    loads = [r[1] for r in new.join(sizes, "vslot").groupBy("shard").agg(F.sum("bytes")).collect()]
    largest = sizes.agg(F.max("bytes")).first()[0]
    assert len(loads) == 10 and max(loads) - min(loads) <= largest  # a slot is not split
    assert new.count() == new.select("vslot").distinct().count() == 512
    grown = sharding.rebalanced(new, sizes, 11)
    moved = grown.join(new.withColumnRenamed("shard", "was"), "vslot").where("shard <> was").count()
    assert moved < 512 * 0.35  # not a rehash


def brute_targets(sizes):
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in sizes if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        rate = left / sum(weight[s] for s in rest) if rest else 0
        new = [s for s in rest if rate * weight[s] > 2 * sizes[s]]
        if not new:
            return {s: 2 * sizes[s] if s in capped else rate * weight[s] for s in sizes}
        capped |= set(new)


def test_mixing(spark, docs, empty):
    labels = spark.createDataFrame([(20, 1), (20, 0), (21, 0), (22, None), (None, 1)], "doc_id long, quality int")
    rows = mixing.measured(docs, labels)
    out = mixing.mix(rows).collect()
    assert len(out) == len(ROWS)
    sizes = Counter()
    for _, t, _, s, *_ in ROWS:
        sizes[s] += len(words(t))
    want = brute_targets(sizes)
    name = {"1": None} | {"0" + s: s for s in sizes if s}
    taken = Counter()
    for r in out:
        assert r["target"] == pytest.approx(want[name[r["skey"]]]) and r["source_size"] == sizes[name[r["skey"]]]
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 2 * r["size"]
        taken[name[r["skey"]]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(len(words(t)) for _, t, _, x, *_ in ROWS if x == s)
    again = mixing.mix(mixing.measured(docs.repartition(3), labels)).select("doc_id", "taken")
    assert sorted(map(str, again.collect())) == sorted(map(str, [type(again.first())(doc_id=r["doc_id"], taken=r["taken"]) for r in out]))
    mixed = mixing.mixed_documents(docs, labels)
    assert mixed.columns == docs.columns
    total = sum(len(words(r["text"])) for r in mixed.collect())
    assert total == pytest.approx(sum(taken.values()), rel=0.01)
    assert mixing.mix(mixing.measured(empty, labels)).count() == 0


def low(t):
    return (t or "").encode().lower().decode()


@pytest.mark.parametrize("limit", [32 << 20, 300])  # the second splits buckets and flushes the local tables
def test_exact_dedup(docs, empty, limit):
    out = exact_dedup.exact_dedup(docs, bucket_bytes=limit, bits=3).collect()
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(low(t), []).append(i)
    want = []
    for i, t, *_ in ROWS:
        g = groups[low(t)]
        keep = max((x for x in g if x is not None), default=None)
        want.append((i, keep, len(g), i == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_content_table_compares_content():
    t = exact_dedup.ContentTable()
    for i in range(500):
        t.add(7, b"%d" % (i % 250), i, 1)  # one hash for all
    assert len(t.texts) == 250 and set(t.counts) == {2} and t.best[0] == 250


def fake_labelled(n, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        ws = [r.choice(VOCAB) for _ in range(r.randint(5, 80))]
        if bad := i % 5 == 0:
            for _ in range(r.randint(1, 4)):
                ws.insert(r.randrange(len(ws)), r.choice(["vilewort", "grubbish", "zlobber" + r.choice("abcdefgh")]))
        out.append((i, " ".join(ws), int(bad)))
    return out


def test_toxicity_held_out_and_spans(spark, docs, empty):
    field = toxicity.fit([(t, y) for _, t, y in fake_labelled(400)])
    test = spark.createDataFrame(fake_labelled(200, seed=9), "doc_id long, text string, y int")
    got = toxicity.scored(test, field).collect()
    assert sum((r["toxicity"]["score"] >= 0.5) == (r["y"] == 1) for r in got) >= 190
    for r in got:
        for s in r["toxicity"]["spans"] if r["y"] else []:
            assert re.search("vilewort|grubbish|zlobber", r["text"][s["start"]:s["end"]])
    assert toxicity.scored(docs, field).count() == len(ROWS) and toxicity.scored(empty, field).count() == 0
    nothing = toxicity.fit([])
    assert {r["toxicity"]["score"] for r in toxicity.scored(docs, nothing).collect()} == {0.0}


def test_toxicity_sample_replaces_long_texts(spark):
    rows = [(i, ("w%d " % i) * (5000 if i % 5 else 5)) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    sample, share = toxicity.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string"), labels, sample=(6, 7))
    assert Counter(y for _, y in sample) == {0: 6, 1: 7} and share == 0.5
    long = spark.createDataFrame([(i, t if i % 2 == 0 else "x" * 9000) for i, t in rows], "doc_id long, text string")
    assert toxicity.fit(*toxicity.labelled_sample(long, labels)).share == 0.5


def test_forward_backward_is_exact():
    import itertools

    import numpy as np
    r = np.random.default_rng(1)
    lengths = [1, 4, 2, 6]
    scores, trans = r.normal(size=13) * 2, r.normal(size=(2, 2))
    starts = np.cumsum(lengths) - lengths
    p, expected = toxicity.forward_backward(scores, starts, trans)
    want, counts = [], np.zeros((2, 2))
    for s, n in zip(starts, lengths, strict=True):
        paths = list(itertools.product((0, 1), repeat=n))
        w = np.array([math.exp(sum(scores[s + i] for i in range(n) if y[i]) + sum(trans[y[i], y[i + 1]] for i in range(n - 1))) for y in paths])
        w /= w.sum()
        want += [sum(x for x, y in zip(w, paths, strict=True) if y[i]) for i in range(n)]
        for x, y in zip(w, paths, strict=True):
            for i in range(n - 1):
                counts[y[i], y[i + 1]] += x
    assert np.allclose(p, want) and np.allclose(expected, counts)


def brute_hits(text, items, n=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    ws, hit, ids = cut(text), set(), set()
    for item, t in items:
        g = cut(t)
        k = min(n, len(g))
        grams = {tuple(g[i:i + k]) for i in range(len(g) - k + 1)} if k else set()
        for i in range(len(ws) - k + 1 if k else 0):
            if tuple(ws[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                ids.add(item)
    return len(ws), len(hit), {str(i) for i in ids if i is not None}


def test_passages_are_cut_by_row_where_ids_repeat_or_are_null(spark):
    r = random.Random(77)
    passage = " ".join("p%d" % r.randrange(10 ** 6) for _ in range(80))
    other = lambda n: " ".join("x%d" % r.randrange(10 ** 6) for _ in range(n))
    low = " ".join(["the"] * 400)  # one word, over and over
    texts = [(1, other(30) + " " + passage), (1, other(5)), (1, other(60) + " " + passage + " " + other(9)), (None, passage + " " + other(40)),
             (None, other(70)), (2, low), (3, low + " the the"), (4, other(55))]
    d = spark.createDataFrame([(*x, "clash") for x in texts], "doc_id long, text string, rid string").repartition(3)
    found = substrings.passages_by_row(d.drop("rid"))
    left = substrings.without_passages(d, found)
    assert left.columns == [*d.columns, "clean_text"]
    rows = left.collect()
    assert len(rows) == len(texts) and sum(passage in x["clean_text"] for x in rows) == 1
    cut = [x for x in rows if x["text"] != x["clean_text"]]
    assert sum("p" in x["text"].split()[0] or passage in x["text"] for x in cut) == 2
    assert sum("the the" in x["clean_text"] and len(x["clean_text"].split()) >= 400 for x in rows) == 1


@pytest.mark.parametrize("block", [16 << 20, 2000])  # the second scans block by block
def test_decontaminate(spark, docs, empty, block):
    items = [(1, prose(30)), (2, BASE[:200]), (3, "one"), (4, None), (None, " ".join(LONG.split()[100:140])), (5, ""), (2, BASE[:200]), (6, "c d e")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.scanned(docs, bench, block_bytes=block).collect()
    want = Counter(brute_hits(t, items)[:2] + (tuple(sorted(brute_hits(t, items)[2])),) for _, t, *_ in ROWS)
    assert Counter((r["report"]["n_words"], r["report"]["n_hit"], tuple(r["report"]["items"])) for r in out) == want
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    cut = {r["doc_id"]: r["clean_text"] for r in decontaminate.without_spans(docs, bench).collect()}
    assert cut[3] == "" and cut[12] == ODD[12] and cut[0] is None
    assert decontaminate.scanned(empty, bench).count() == 0
    assert decontaminate.scanned(docs, bench.limit(0)).where("report.n_hit > 0").count() == 0


def test_passages(spark, empty):
    r = random.Random(11)
    text = lambda n: " ".join("u%d" % r.randrange(10 ** 6) for _ in range(n))
    shared, other = text(60), text(55)
    near = shared.split()
    near[30] = "changed"
    texts = [text(80), shared + " " + text(40), text(30) + " " + shared.upper(), text(100) + " " + other, other, text(20) + " " + " ".join(near) + " " + text(9),
             None, "", "x", "same " * 300, text(3000) + " " + shared]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 2), (None, text(70), 3)], "doc_id long, text string, start int")
    found = substrings.repeated_passages(d).collect()
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i
    for x in found:
        parent[root(x["doc_id"])] = root(x["of_doc_id"])
        assert x["end"] - x["start"] >= 50
        if x["doc_id"] != 5 and x["of_doc_id"] != 5:
            a = texts[x["doc_id"]].lower().split()[x["start"]:x["end"]]
            assert a == texts[x["of_doc_id"]].lower().split()[x["of_start"]:x["of_end"]]
    assert {1, 2, 5, 10, 3, 4} == set(parent)
    assert root(1) == root(2) == root(10) == root(5) and root(3) == root(4) != root(1)
    assert substrings.repeated_passages(empty).count() == 0


def test_passages_leave_one_occurrence(spark):
    r = random.Random(23)
    text = lambda n: ["u%d" % r.randrange(10 ** 6) for _ in range(n)]
    shared = [text(50 + i % 2 * 50) for i in range(60)]
    rows = [(2 * i + k, " ".join(text(25) + p + text(25))) for i, p in enumerate(shared) for k in (0, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeated_passages(d).collect()
    assert {frozenset((x["doc_id"], x["of_doc_id"])) for x in found} == {frozenset((2 * i, 2 * i + 1)) for i in range(60)}
    left = {x["doc_id"]: x["clean_text"] for x in substrings.without_passages(d, spark.createDataFrame(found)).collect()}
    for i, p in enumerate(shared):
        assert sum(" ".join(p) in left[2 * i + k] for k in (0, 1)) == 1


@pytest.mark.parametrize("block", [2048, 4])  # the second deals a value's windows out as pairs of blocks
def test_passages_among_edited_copies(spark, block, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", block)
    r = random.Random(31)
    text = lambda n: ["u%d" % r.randrange(10 ** 6) for _ in range(n)]
    texts, spans = [], []
    for _ in range(12):
        base = text(60)
        for _ in range(10):
            copy = list(base)
            for _ in range(r.randrange(4)):
                copy[r.randrange(60)] = text(1)[0]
            before = text(20 + r.randrange(30))
            texts.append(before + copy + text(30))
            spans.append((len(before), copy))
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rid = {x["doc_id"]: x["rid"] for x in d.select("doc_id", F.xxhash64("doc_id", "text").alias("rid")).collect()}
    found = substrings.repeated_passages(d).collect()
    grams = lambda t: {tuple(t[i:i + 5]) for i in range(len(t) - 4)}
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x in found:
        a, b = texts[x["of_doc_id"]][x["of_start"]:x["of_end"]], texts[x["doc_id"]][x["start"]:x["end"]]
        assert min(len(a), len(b)) >= 50 and rid[x["of_doc_id"]] < rid[x["doc_id"]]
        assert 100 * len(grams(a) & grams(b)) >= 80 * len(grams(a) | grams(b))
        parent[root(x["doc_id"])] = root(x["of_doc_id"])
    later = {x["doc_id"] for x in found}
    pairs = 0
    for g in range(0, len(texts), 10):
        for i in range(g, g + 10):
            for j in range(g, i):
                a, b = grams(spans[i][1]), grams(spans[j][1])
                if 100 * len(a & b) >= 80 * len(a | b):
                    pairs += 1
                    assert root(i) == root(j) and max(i, j, key=rid.get) in later
    assert pairs >= 100


def test_word_hashes(monkeypatch):
    r = random.Random(3)
    texts = ["", "  ", "a", " A\tb\n", "ab ba aab baa aaa aa a", "é\u2003x ÉX", "w" * 300 + " " + "W" * 300 + "x " * 40, " ".join("ab"[r.randrange(2)] * r.randrange(1, 9) for _ in range(2000))]
    for part in (substrings.PART, 7):
        monkeypatch.setattr(substrings, "PART", part)
        known = {}
        for t in texts:
            words = t.encode().lower().split()
            found = substrings.word_hashes(t.encode()).tolist()
            assert len(found) == len(words)
            assert all(known.setdefault(w, h) == h for w, h in zip(words, found))
        assert len(set(known.values())) == len(known)
    assert len(substrings.word_hashes(None)) == 0


@pytest.mark.parametrize("chunk", [32 << 20, 500])
def test_token_counts(docs, empty, chunk):
    from tokenizers import Tokenizer
    path = _tokenizer("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    out = token_counts.token_counts(docs, path, chunk_bytes=chunk).collect()
    want = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ROWS]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    assert token_counts.token_counts(empty, path).count() == 0


def test_pre_tokens_as_the_library():
    from tokenizers import Tokenizer
    path = _tokenizer("byte_bpe_50k.json")
    tok, pre, r = Tokenizer.from_file(path), token_counts.PreTokens(path), random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "bc", "'s", "'ll", "é", "<|endoftext|>", "1", "23", "!", "...", "\x1c", "\x85", "中", "👍", "<|", "The", "\r\n", " x"]
    for _ in range(3000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 12)))
        known, freq = pre.count(t)
        ids = list(pre.ids)
        assert known + sum(n * len(pre.model.tokenize(ids[i])) for i, n in freq.items()) == len(tok.encode(t, add_special_tokens=False).ids), t


def test_chat_round_trip(spark):
    nasty = [r"\### Assistant: </turn> ok", "a<b#c:d\\e\\\\", "", None, "\n### user:\n</turn>\n", "x" * 50000, r"\l\h\b\c"]
    rows = [(c, t, role, nasty[(c + t) % len(nasty)], 9) for c in range(6) for t, role in enumerate(["system", "user", "assistant", "odd:role\n", None, "user"])]
    rows += [(6, 0, "user", "hi", 1), (6, 1, "assistant", "yo", 1), (6, 1, "assistant", "yo", 1), (None, None, None, None, None)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat.format_conversations(d).withColumn("back", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.masked(F.col("formatted"), F.col("loss_spans")))
    for r in out.collect():
        own = sorted(((t is not None, t or 0, role or "", x or "") for c, t, role, x, _ in rows if c == r["conv_id"]))
        assert [(x["role"], x["text"]) for x in r["back"]] == [(role, x) for _, _, role, x in own]
        assert r["loss"] == "".join(x for _, _, role, x in own if role == "assistant")
        assert r["valid"] is False
    assert chat.op8_chat(spark, d.limit(0)).select("conv_id", "n_turns", "valid").collect() == [(-7, 2, True)]


def brute_components(texts, percent=85):
    sets = {}
    for i, t in texts:
        w = words(t)
        n = min(5, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set()
    comp = {i: i for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                a, b = sorted((comp[i], comp[j]))
                comp = {k: a if v == b else v for k, v in comp.items()}
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


@pytest.mark.parametrize("block", [2048, 3])  # the second deals lists and clusters out as pairs of blocks
def test_near_duplicates(spark, empty, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "LIST_BLOCK", block)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", 4096 if block == 3 else 16 << 20)
    monkeypatch.setattr(near_dedup, "CLUSTER_BLOCK", block)
    r = random.Random(2)
    bases = [[r.choice(VOCAB) for _ in range(n)] for n in (40, 90, 150, 150, 300, 7)]
    texts = [None, "", " ", "a b", "A B", "a b c"]
    for b in bases:
        for edits in (0, 0, 1, 1, 1, 2, 3, 4):
            w = list(b)
            for _ in range(edits):
                w[r.randrange(len(w))] = "edit%d" % r.randrange(10 ** 6)
            texts.append(" ".join(w))
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = {x["doc_id"]: tuple(x)[1:] for x in near_dedup.near_duplicates(d).collect()}
    assert got == brute_components(list(enumerate(texts)))
    stays = near_dedup.one_of_each(d)
    assert stays.columns == d.columns and {x["doc_id"] for x in stays.collect()} == {i for i, x in got.items() if x[2]}
    if block == 2048:
        assert near_dedup.near_duplicates(empty).count() == 0
        odd = spark.createDataFrame([(None, "p q r"), (1, "p q r"), (1, "p q r"), (None, None)], "doc_id long, text string")
        assert sorted(map(str, map(tuple, near_dedup.near_duplicates(odd).collect()))) == sorted(
            ["(None, 1, 1, False)", "(1, 1, 1, True)", "(1, 1, 1, True)", "(None, 0, None, True)"])


def test_one_of_each_of_repeats_nulls_ties_and_clashing_names(spark, empty):
    cols = "doc_id long, text string, rid string, component string, place map<string,int>, stays boolean"
    rows = [(1, "p q r", "a", None, None, True), (1, "p q r", "b", None, {"x": 1}, False), (2, "P Q R", "c", None, None, None),
            (2, "p q r", "c", None, None, None), (None, "z z z", "d", "x", None, None), (None, "z z z", "d", "x", None, None),
            (None, "Z z z", "d", None, None, None), (None, "p q r", None, None, None, None), (7, "z y", None, None, None, None),
            (7, "z y", None, None, None, None), (8, "", None, None, None, None), (8, "", None, None, None, None),
            (None, None, None, None, None, None), (None, " ", None, None, None, None), (9, "z y", "k", None, None, None)]
    d = spark.createDataFrame(rows, cols).repartition(4)
    out = near_dedup.one_of_each(d, percent=80)
    assert out.columns == d.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "").lower().strip()) for r in out.collect())
    assert got == sorted([("1", "p q r"), ("None", "z z z"), ("7", "z y"), ("8", ""), ("8", ""), ("None", ""), ("None", "")])
    kept = {r["doc_id"]: r["rid"] for r in out.where("doc_id in (1, 7)").collect()}
    again = {r["doc_id"]: r["rid"] for r in near_dedup.one_of_each(d.repartition(3), percent=80).where("doc_id in (1, 7)").collect()}
    assert kept == again
    hot = spark.range(3000).select((F.col("id") % 2).alias("doc_id"), F.lit("one text for all").alias("text"), "id")
    assert [r["doc_id"] for r in near_dedup.one_of_each(hot).collect()] == [0]
    assert near_dedup.one_of_each(empty).count() == 0


def test_near_duplicates_at_other_similarities(spark):
    r = random.Random(8)
    rows = []
    for i in range(40):
        base = ["u%d" % r.randrange(10 ** 6) for _ in range(100)]
        copy = list(base)
        copy[30], copy[60] = "changed", "too"  # 86 of 106 shingles, 0.81
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x["doc_id"] for x in near_dedup.one_of_each(d, percent=80).collect()) == list(range(0, 80, 2))
    assert near_dedup.one_of_each(d).count() == 80
    assert near_dedup.matches(85) == 18 and near_dedup.matches(80) < 18


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 560)]
    comp = {x: x for a, b in links for x in (a, b)}
    for a, b in links:
        lo, hi = sorted((comp[a], comp[b]))
        comp = {k: lo if v == hi else v for k, v in comp.items()}
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: c for x, c in comp.items() if any(x in p and p[0] != p[1] for p in links)}


@pytest.mark.parametrize("chunk", [8 << 20, 700])
def test_katz(docs, empty, chunk):
    held = F.col("doc_id") % 4 == 1
    got = lm_scoring.score_documents(docs, F.coalesce(held, F.lit(False)), chunk_bytes=chunk, bucket_keys=1 << 21 if chunk > 700 else 64).collect()
    toks = [(i, t, [*words(t), None], i is not None and i % 4 == 1) for i, t, *_ in ROWS]
    c1, c2, cs = Counter(), Counter(), Counter()
    for _, _, w, out in toks:
        if not out:
            c1.update(w)
            c2.update(zip(["<s>", *w[:-1]], w, strict=True))
            cs.update(["<s>", *w[:-1]])
    n, v, k = sum(c1.values()), len(c1), lm_scoring.K
    d1, d2 = (lm_scoring.discounts([sum(x == r for x in c.values()) for r in range(1, k + 2)]) for c in (c1, c2))
    disc = lambda r, d: r * d[r - 1] if r <= k else r - lm_scoring.TOP
    left = 1 - sum(disc(x, d1) for x in c1.values()) / n
    p1 = lambda w: disc(c1[w], d1) / n if w in c1 else left
    num, den = Counter(), Counter()
    for (h, w), r in c2.items():
        num[h] += disc(r, d2) / cs[h]
        den[h] += p1(w)

    def p2(h, w):
        if (h, w) in c2:
            return disc(c2[h, w], d2) / cs[h]
        return p1(w) if h not in cs else (1 - num[h]) / (1 - den[h]) * p1(w)
    for h in ("<s>", b"one", b"w1"):
        assert sum(p2(h, w) for w in c1) + p2(h, b"unknown!") == pytest.approx(1)
    want = sorted((str(i), out, len(w), sum(x in c1 for x in w), n, round(sum(math.log10((c1[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5),
                   round(sum(math.log10(p2(h, x)) for h, x in zip(["<s>", *w[:-1]], w, strict=True)), 5)) for i, _, w, out in toks)
    have = sorted((str(r[0]), *r[1:5], round(r[5], 5), round(r[6], 5)) for r in got)
    assert [x[:5] for x in have] == [x[:5] for x in want]
    for a, b in zip(have, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], abs=1e-3)
    assert lm_scoring.score_documents(empty, held).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, cur.fetchall()))


def test_pipeline(spark, empty, tmp_path):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for (_, stage), check in zip(p.STAGES[:4], (
            lambda a, b: b <= a, lambda a, b: b <= a, lambda a, b: b <= a, lambda a, b: set(b) <= set(a)), strict=True):
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
        assert check(ids(docs), ids(out))
    toxic = {r["doc_id"] for r in queries.op4_toxicity(spark, SF_SMALL).where("predicted = 1").collect()}
    near = {r["doc_id"] for r in near_dedup.near_duplicates(docs, percent=80).where("not kept").collect()}
    op9 = {r["doc_id"] for r in queries.op9_near_dedup(spark, SF_SMALL).where("not kept").collect()}
    bench = {r["doc_id"] for r in queries.op5_decontaminate(spark, SF_SMALL).where("contaminated").collect()}
    whole = {r["doc_id"] for r in docs.collect()}
    for (_, stage), gone in zip(p.STAGES[:3], (toxic, near, bench), strict=True):
        assert {r["doc_id"] for r in stage(spark, docs, SF_SMALL).collect()} == whole - gone
    assert {r["doc_id"] for r in near_dedup.one_of_each(docs, percent=85).collect()} == whole - op9
    last = p.run(spark, SF_SMALL)
    assert last.columns == [*docs.columns, "vslot", "shard"] and last.count() > 0
    none = docs.limit(0)
    for _, stage in p.STAGES:
        none = stage(spark, none, SF_SMALL)
        assert none.count() == 0
        none = none.select(*docs.columns)


def test_pipeline_on_odd_rows_and_clashing_names(spark, tmp_path):
    import corpus_pipeline as p
    tables = str(tmp_path)
    cols = DOCS + ", toxicity string, report int, _id string, _weight int, skey string, _epochs int, _cut int, _copy int, _new int, vslot string"
    own = ("tox", 5, "id", 6, "sk", 7, 8, 9, 10, "vs")
    odd = [(*r, *own) for r in ROWS] + [(None, BASE, "en", "s1", None, None, None, *own), (3, "one", None, None, None, None, None, *own)]
    docs = spark.createDataFrame(odd, cols).repartition(4)
    item = prose(30)
    spark.createDataFrame([("i1", item, None), ("i2", None, None)], "item_id string, text string, split string").write.parquet(f"{tables}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 5 == 2), i % 3, "en") for i in range(75)],
                          "doc_id long, toxic int, quality int, lang string").write.parquet(f"{tables}/labels.parquet")
    dirty = spark.createDataFrame([(900, item, "en", "s0", None, None, None, *own)], cols)
    docs = docs.union(dirty)
    whole = Counter(map(str, map(tuple, docs.collect())))
    for name, stage in p.STAGES[:3]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns, name
        left = Counter(map(str, map(tuple, out.collect())))
        assert left and not left - whole, name
        if name == "benchmark decontamination":
            assert sum((whole - left).values()) == 1 and not any("(900," in r for r in left)
        if name == "near duplicates":
            kept = Counter((r["doc_id"], r["text"]) for r in out.collect() if words(r["text"]))
            assert max(kept.values()) == 1
            want = brute_components([(r[0], r[1]) for r in odd if r[0] is not None] + [(900, item)], 80)
            assert {i for i, _ in kept if i is not None} == {i for i, x in want.items() if x[2] and x[0]}
    mixed = p.mix_sources(spark, docs, tables)
    assert mixed.columns == docs.columns
    assert set(map(str, map(tuple, mixed.collect()))) <= set(whole)
    dealt = p.deal_shards(spark, mixed, tables)
    assert dealt.columns == [*[c for c in docs.columns if c not in ("vslot", "shard")], "vslot", "shard"]
    assert dealt.count() == mixed.count()


def test_shards_of_the_given_table_are_even(spark):
    rows = queries.op1_sharding(spark, SF_SMALL.replace("0.001", "0.01")).groupBy("shard").agg(F.sum("size").alias("b"), F.max("size").alias("m")).collect()
    sizes = [r["b"] for r in rows]
    assert len(rows) == 24 and max(sizes) - min(sizes) <= max(r["m"] for r in rows)
