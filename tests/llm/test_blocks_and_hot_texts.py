"""Benchmark blocks by exact byte sums, and exact duplicates whose copies are dealt to several tables."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from seqcat.llm import decontaminate, exact_dedup


@pytest.mark.parametrize("block", [64, 200, 1000])
def test_blocks_of_the_benchmark(spark, block):
    r = random.Random(block)
    rows = [(i, "ä" * r.randrange(1, 60)) for i in range(120)] + [(500 + i, "x" * n) for i, n in enumerate((block, block + 1, block * 3, block // 2 + 1))]
    rows += [(7, "same"), (7, "same"), (None, "no id"), (8, None), (9, "")]
    items = spark.createDataFrame([(None if i is None else str(i), t) for i, t in rows], "item string, text string")
    got, n_blocks = decontaminate.in_blocks(items, block)
    have, held = got.collect(), defaultdict(list)
    for x in have:
        held[x.block].append(len(x.text.encode()))
    assert Counter((x.item, x.text) for x in have) == Counter({(None if i is None else str(i), t) for i, t in rows if t})
    assert sorted(held) == list(range(n_blocks))
    assert all(sum(sizes) <= block or len(sizes) == 1 for sizes in held.values())
    assert n_blocks <= 4 + 3 * sum(map(sum, held.values())) / block
    assert decontaminate.in_blocks(items.limit(0), block)[1] == 0


def test_small_blocks_give_the_same_report(spark):
    r = random.Random(5)
    word = lambda: "w%d" % r.randrange(400)
    bench = [(i, " ".join(word() for _ in range(r.randrange(1, 40)))) for i in range(30)]
    docs = [(i, " ".join([*(word() for _ in range(20)), *(r.choice(bench)[1].split() if i % 3 == 0 else []), word()])) for i in range(60)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    whole, cut = (sorted(decontaminate.scanned(d, b, block_bytes=n).collect()) for n in (1 << 20, 1500))
    assert whole == cut and any(x.report.n_hit for x in whole)


@pytest.mark.parametrize("hot_rows", [1, 5, 1 << 16])
def test_hot_texts_over_several_tables(spark, hot_rows):
    r = random.Random(11)
    rows = [(i, r.choice(["Hot text", "hot TEXT", None, "", "one %d" % i, "pair %d" % (i // 2)])) for i in range(600)]
    rows += [(None, "hot text"), (None, "only null ids"), (None, "only null ids"), (3, "hot text"), (3, "hot text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_dedup.exact_dedup(docs, bucket_bytes=300, hot_rows=hot_rows).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").lower()].append(i)
    want = []
    for i, t in rows:
        ids = groups[(t or "").lower()]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").lower().encode()).hexdigest()))
    assert Counter(map(tuple, got)) == Counter(want)


def test_every_two_wordings_of_a_passage_are_linked():
    """Also where links to a third one join them already, and where the first windows of both are of one document."""
    import numpy as np

    from seqcat.llm.substrings import NEAR, linked
    base = np.arange(1, 2 * NEAR + 2, dtype=np.uint32)

    def wording(place):
        t = base.copy()
        t[place] = 10_000 + place
        return t.tobytes()
    pairs = lambda rid, tokens: {x[:2] for x in linked(rid, [0] * len(rid), [NEAR] * len(rid), tokens)}
    assert pairs([1, 2, 3], [base.tobytes(), wording(3), wording(90)]) == {(1, 2), (1, 3), (2, 3)}
    a, b = wording(3), wording(90)
    found = {x[:2] for x in linked([1, 1, 2, 3], [0, 500, 0, 0], [NEAR, 500 + NEAR, NEAR, NEAR], [a, b, a, b])}
    assert found == {(1, 2), (1, 3), (2, 3)}  # equal windows, and both wordings


def test_windows_proved_together_as_one_by_one():
    """Batches of window pairs give the passages that the proof of a single pair gives; also with repeated tokens."""
    import numpy as np

    from seqcat.llm.substrings import TOKENS, Tokens, passages, proved
    rng, pairs, expected = np.random.default_rng(5), [], []
    for n in range(400):
        x = rng.integers(1, 4 if n % 4 == 0 else 5000, int(rng.integers(TOKENS, 98))).astype(np.uint32)
        y = np.where(rng.random(len(x)) < rng.choice([0, 0.02, 0.05, 0.1]), rng.integers(1, 9, len(x)), x).astype(np.uint32)
        y = y[int(rng.integers(0, 4)):]
        c, d = int(rng.integers(0, len(x))), int(rng.integers(0, len(y)))
        x[c] = y[d] if n % 2 else x[c]
        pairs.append((1, n, 100 + c, 200 + d, 100, 200, x.tobytes(), y.tobytes()))
        expected += [(1, n, 100 + c, 200 + d, 100 + p, 100 + q, 200 + s, 200 + e) for p, q, s, e in passages(Tokens(x), y, np.array([[c, d, 0, 0, 0, 0]]))]
    assert 100 < len(expected) < 400
    assert proved(pairs) == expected


def test_equal_windows_are_one_class_before_their_tokens_travel():
    """Windows sorted by value, key, document, place, in batches of any size: one row a class, a link for every equal one, of shared values."""
    import random
    from collections import defaultdict

    import pyarrow as pa

    from seqcat.llm.substrings import CLASS, _classes
    r = random.Random(3)
    rows = sorted({(r.randrange(40), key := r.randrange(3), r.randrange(3), (6 * key + r.randrange(6)) << 14) for _ in range(300)})
    values, links, firsts = defaultdict(list), set(), set()
    for kv, key, rid, place in rows:
        values[kv].append((key, rid, place))
    for kv, own in values.items():
        classes = defaultdict(list)
        for key, *window in own:
            classes[key].append(tuple(window))
        for first, *more in classes.values():
            others = [w for w in more if w[0] != first[0]]
            links.update((*first, *w) for w in others)
            if len(classes) > 1 and len({rid for _, rid, _ in own}) > 1:
                firsts.add((kv, *first, *(others[0] if others else (None, None))))
    for size in (1, 2, 7, 1000):
        batches = [pa.record_batch(dict(zip(("kv", "key", "rid", "place"), map(pa.array, zip(*rows[i:i + size]))))) for i in range(0, len(rows), size)]
        found = [tuple(x[c] for c in CLASS) for b in _classes(batches) for x in b.to_pylist()]
        assert len(found) == len(firsts) + sum(x[0] is None for x in found)
        assert {x for x in found if x[0] is not None} == firsts
        assert {x[1:] for x in found if x[0] is None} == links
    assert list(_classes([])) == []


def test_many_windows_of_a_value_and_pairs_of_blocks_lose_no_link(monkeypatch):
    import numpy as np

    from seqcat.llm import substrings
    rng = np.random.default_rng(8)
    base = rng.integers(1, 1 << 32, (3, 97))
    tokens = [np.where(rng.random(97) < 0.04, rng.integers(1, 1 << 32, 97), base[i % 3]).astype(np.uint32).tobytes() for i in range(60)]
    rows = [[i // 2 for i in range(60)], [0] * 60, [substrings.NEAR] * 60, tokens]
    found = []
    for few in (0, 100):
        monkeypatch.setattr(substrings, "FEW", few)
        found.append(sorted(substrings.linked(*rows)))
        block = [i % 5 // 2 for i in range(60)]
        dealt = set()
        for lo in range(3):
            for hi in range(lo, 3):
                part = [i for i in range(60) if block[i] in (lo, hi)]
                equal, pairs = substrings.likely(*([x[i] for i in part] for x in rows), others=[None if i else (99, 0, substrings.NEAR) for i in part], own=[block[i] for i in part] if lo < hi else ())
                dealt.update(equal + [x for some in substrings._batched(pairs) for x in substrings.proved(some)])
        assert dealt == set(found[-1])
    assert found[0] == found[1] and len(found[0]) > 100
