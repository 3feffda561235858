"""Fill-in-middle, conversation prefix trie and SimHash near duplicates against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seqcat.llm import fill_middle, prefix_trie, queries, simhash
from tests.conftest import SF_SMALL

R = random.Random(11)
DOCS = "doc_id long, text string, form string, h1 long, fp long, n int"
LONG = "\n".join("zeile %d é中👍" % i * R.randint(0, 3) for i in range(30000))
TEXTS = [None, "", "\n", "\n\n\n", "one line", "a\nb\nc", "a\nb\nc\n", "é\n中\n👍\n", "x<P>y\nz", "<S>", "tail <M>\n", "< P>\n<", "\r\n\x00\n\x0b\n\x8a", LONG,
         "1234567\n", "12345678\n", "123456\n8\n"] + ["\n".join(R.choice(["", "ab", "中文", "x" * R.randint(1, 20)]) for _ in range(R.randint(1, 30))) for _ in range(150)]
ROWS = [(i, t, "clash", 1, 2, 3) for i, t in enumerate(TEXTS)]
ROWS += [ROWS[5], (None, "a\nb\n", "clash", 1, 2, 3), (None, None, None, None, None, None), (-3, "neg\native", "", 0, 0, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(5).cache()


def cut(doc_id, text, unit, fim=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    i, j = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return doc_id, len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


@pytest.mark.parametrize(("unit", "fim", "spm"), [("line", 100, 50), ("char", 60, 20)])
def test_fill_in_middle_cuts_like_brute_force(docs, unit, fim, spm):
    out = fill_middle.fill_in_middle(docs, unit=unit, fim_percent=fim, spm_percent=spm)
    back = out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    want = [cut(i, t, unit, fim, spm) for i, t, *_ in ROWS]
    key = str
    assert sorted((tuple(r)[:6] for r in back), key=key) == sorted(want, key=key)
    assert sorted(r["back"] for r in back) == sorted(t or "" for _, t, *_ in ROWS)


def test_words_mark_and_select_every_byte_pattern():
    rng = np.random.default_rng(3)
    data = rng.choice(np.array([0x0A, 0x0B, 0x8A, 0x09, 0x00, 0xFF, 0x0A ^ 0x80, 0x41], dtype=np.uint8), 5003)
    words = fill_middle.word_view(data)
    marks = fill_middle.Marks(fill_middle.newline_marks(words))
    places = np.flatnonzero(data == 10)
    assert (marks.select(np.arange(1, len(places) + 1)) == places).all()
    at = np.arange(len(data) + 1)
    assert (marks.rank(at) == np.searchsorted(places, at)).all()
    starts = fill_middle.Marks(fill_middle.start_marks(words)).rank(np.array([len(data)]))
    assert starts[0] == ((data & 0xC0) != 0x80).sum()


def test_fill_in_middle_query(spark, docs):
    got = {str(tuple(r)) for r in fill_middle.op12_fill_in_middle(docs).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {str((*w[:5], sha(w[5]), sha(t or ""))) for w, (_, t, *_) in ((cut(r[0], r[1], "line"), r) for r in ROWS)}
    assert got == want
    empty = spark.createDataFrame([], DOCS)
    assert fill_middle.op12_fill_in_middle(empty).count() == 0
    with pytest.raises(ValueError, match="unit"):
        fill_middle.fill_in_middle(docs, unit="word")


def brute_trie(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        head = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = tuple(own.get(head, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    out = []
    for node, cs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) > len(x) and y[:len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == node)))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


CONVS = "conv_id long, turn long, role string, text string, depth int, n long, node string"


def conversations(seed):
    r = random.Random(seed)
    out = [(None, 0, "user", "lost"), (100, None, None, None), (100, 0, "user", None), (100, 0, "user", None), (100, 1, "a", "é👍"), (7, 0, "user", "x"),
           (-250, 0, "user", "neg"), (-200, 0, "user", "head"), (-200, 1, "assistant", "head too")]
    for c in [0, 1, 2, 3, 5, 8, 101, 102, 103, 200, 201, 305, 306, 307, 399, *range(400, 440)]:
        ts = [(c, t, r.choice(["user", "assistant"]), r.choice(["", "hi", "hello there", "ok"])) for t in range(r.randint(1, 8))]
        out += ts + (ts[:1] if c % 7 == 0 else [])
    long = [(500 + k, t, "user", f"turn {t}") for k in range(60) for t in range(9)]  # copies
    long += [(600, t, "user", f"deep {t % 3}") for t in range(700)] + [(601, t, "user", f"deep {t % 3}") for t in range(699)]
    return [(*x, 1, 2, "clash") for x in out + long]


@pytest.mark.parametrize("shard_ids", [prefix_trie.SHARD_IDS, 1, 40])
def test_trie_matches_brute_force(spark, shard_ids):
    rows = conversations(shard_ids)
    table = spark.createDataFrame(rows, CONVS).repartition(4)
    small = [x[:4] for x in rows if x[0] is None or x[0] < 600]
    got = prefix_trie.op11_prefix_trie(table.where("conv_id is null or conv_id < 600"), shard_ids).collect()
    assert sorted(map(tuple, got), key=str) == brute_trie(small)
    if shard_ids == 40:  # deep sequences, one the beginning of the other, cut over shards
        deep = prefix_trie.prefix_trie(table.where("conv_id >= 600"), shard_ids).collect()
        assert sorted(map(tuple, deep), key=str) == brute_trie([x[:4] for x in rows if x[0] is not None and x[0] >= 600], rebuild=False)


def test_trie_edges(spark):
    assert prefix_trie.op11_prefix_trie(spark.createDataFrame([], CONVS)).count() == 0
    lost = spark.createDataFrame([(None, 0, "user", "x", 1, 1, "")], CONVS)
    assert prefix_trie.op11_prefix_trie(lost).count() == 0
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 2)  # its two turns go, and no conversation 0 gives others
    turnless = [(c, 0, "user", "x"), (c, 1, "user", "y")]
    got = prefix_trie.op11_prefix_trie(spark.createDataFrame([(*t, 1, 1, "") for t in turnless], CONVS)).collect()
    assert [tuple(r) for r in got] == brute_trie(turnless) and got[0]["n_leaves"] == 1


def test_seam_counts_when_a_shard_ends_in_a_beginning():
    seqs = [([1], [5], 1, 1, "a"), ([1, 2], [5, 7], 2, 2, "b"), ([1, 2, 3], [5, 7, 1], 1, 4, "c"), ([1, 3], [5, 2], 1, 9, "d")]
    whole = {(r[1], r[0]): r for r in prefix_trie.shard_nodes(seqs, -1, -1)}
    for at in (1, 2, 3):
        shared = sum(x == y for x, y in zip(seqs[at - 1][0], seqs[at][0], strict=False))
        parts = [*prefix_trie.shard_nodes(seqs[:at], -1, shared), *prefix_trie.shard_nodes(seqs[at:], shared, -1)]
        merged = {}
        for r in parts:
            key = r[8] or (r[1], r[0])
            old = merged.get(key)
            merged[key] = r if old is None else (min(old[0], r[0]), r[1], None, *[old[i] + r[i] for i in range(3, 7)], old[7] or r[7])
        assert {(r[1], r[0]): (*r[3:7], r[7]) for r in merged.values()} == {k: (*r[3:7], r[7]) for k, r in whole.items()}


def low_words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())


def slow_fingerprint(t):
    words = low_words(t)
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    nodes, up = sorted(set(fps)), {}
    def root(x):  # noqa: E306
        while up.get(x, x) != x:
            x = up[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                up[root(b)] = root(a)
    return {x: root(x) for x in nodes}


def planted(n, seed):
    """Fingerprints with chains, balls and pairs at distances 1 to 6."""
    r = random.Random(seed)
    out = [0, 1, 3, (1 << 64) - 1, 1 << 63]
    for _ in range(n):
        x = r.getrandbits(64)
        out.append(x)
        for _ in range(r.randint(0, 6)):
            y = x
            for bit in r.sample(range(64), r.randint(1, 6)):
                y ^= 1 << bit
            out.append(y)
            x = r.choice([x, y])
    return out


@pytest.mark.parametrize("bucket_variants", [simhash.BUCKET_VARIANTS, 4000])
def test_links_join_what_brute_force_joins(spark, bucket_variants):
    fps = sorted(set(planted(120, 3)) | {x ^ y for x in (5 << 40,) for y in range(64)})  # and a ball of 64
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long").cache()
    levels = simhash.buckets(nodes, bucket_variants=bucket_variants)
    assert len(levels) == 1 if bucket_variants > 4000 else len(levels) > 1
    found = {}
    def root(x):  # noqa: E306
        while found.get(x, x) != x:
            x = found[x]
        return x
    for a, b in simhash.links(nodes, bucket_variants=bucket_variants).collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 64
        x, y = sorted((root(a), root(b)))
        found[y] = x
    want = brute_components(fps)
    groups = defaultdict(set)
    for x, s in zip(fps, signed, strict=True):
        groups[root(s)].add(x)
    brute = defaultdict(set)
    for x, c in want.items():
        brute[c].add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_variants_are_the_ball():
    fps = np.array([0, 0b1011], dtype=np.uint64)
    values, owners = simhash.variants(fps, np.array([2, 1]), 10)
    assert len(values) == simhash.variant_count(10, 2) + simhash.variant_count(10, 1)
    assert {int(v) for v in values[owners == 0]} == {v for v in range(1024) if v.bit_count() <= 2}
    assert {int(v) for v in values[owners == 1]} == {v for v in range(1024) if (v ^ 11).bit_count() <= 1}
    assert simhash.variant_count(64, 2) == 2081


def test_simhash_query(spark):
    r = random.Random(9)
    vocab = ["w%d" % i for i in range(400)]
    texts = [None, "", "  \t", "one", "One", "a b\x0bc", "a b c d", "A B c\nd e", LONG, LONG + " more", "x " * 500]
    for _ in range(25):
        words = r.choices(vocab, k=r.randint(40, 200))
        texts.append(" ".join(words))
        for _ in range(r.randint(0, 3)):
            words = list(words)
            words[r.randrange(len(words))] = "edit"
            texts.append(" ".join(words))
    rows = [(i, t, "clash", 1, 2, 3) for i, t in enumerate(texts)]
    rows += [rows[12], (None, texts[14], "", 1, 1, 1), (None, "nobody else says this", "", 1, 1, 1), (None, None, "", 1, 1, 1)]
    fps = [slow_fingerprint(t) for _, t, *_ in rows]
    component, least = brute_components(fps), {}
    for (i, *_), x in zip(rows, fps, strict=True):
        if i is not None:
            least[component[x]] = min(least.get(component[x], i), i)
    want = [(i, format(x, "016x"), least.get(component[x])) for (i, *_), x in zip(rows, fps, strict=True)]
    got = simhash.op13_simhash(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert simhash.op13_simhash(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError, match="even"):
        simhash.near_fingerprints(spark.createDataFrame([], DOCS), radius=3)


def test_simhash_on_given_table_matches_all_pairs(spark):
    got = queries.QUERIES["op13_simhash"](spark, SF_SMALL).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall())
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    component, least = brute_components(list(fps.values())), {}
    for i, x in fps.items():
        least[component[x]] = min(least.get(component[x], i), i)
    assert {(r[0], r[1], r[2]) for r in got} == {(i, format(x, "016x"), least[component[x]]) for i, x in fps.items()}
