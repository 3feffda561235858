"""Katz backoff of any order against a recursive brute-force model."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqcat.llm import lm_scoring

WORDS = ["a", "b", "c", "dd", "Ee", "ff", "g", "hh"]


def corpus():
    r = random.Random(19)
    rows = [(i, " ".join(r.choices(WORDS, [30, 20, 10, 8, 5, 3, 2, 1], k=r.randrange(1, 30)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "  "), (None, "a b c"), (7, "a b c"), (7, "a b c"), (205, "new words only here")]
    return rows + [(300 + i, "a b g hh " * 12) for i in range(3)]


class Brute:
    """P(token | tokens before) as the module's docstring defines it, by recursion over the orders."""

    def __init__(self, texts, order):
        self.order, self.counts, self.followers = order, [Counter() for _ in range(order + 1)], defaultdict(set)
        self.context = [Counter() for _ in range(order + 1)]
        for t in texts:
            w = ["<s>"] * (order - 1) + t
            for i in range(order - 1, len(w)):
                for m in range(1, order + 1):
                    gram = tuple(w[i - m + 1:i + 1])
                    self.counts[m][gram] += 1
                    self.context[m][gram[:-1]] += 1
                    self.followers[gram[:-1]].add(w[i])
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        self.d = [None, *(lm_scoring.discounts([sum(x == r for x in c.values()) for r in range(1, lm_scoring.K + 2)])
                          for c in self.counts[1:])]

    def discounted(self, r, m):
        return r * self.d[m][r - 1] if r <= lm_scoring.K else r - lm_scoring.TOP

    def p(self, h, w):
        m = len(h) + 1
        r = self.counts[m][(*h, w)]
        if m == 1:
            return self.discounted(r, 1) / self.n if r else 1 - sum(self.discounted(x, 1) for x in self.counts[1].values()) / self.n
        if r:
            return self.discounted(r, m) / self.context[m][h]
        if not self.context[m][h]:
            return self.p(h[1:], w)
        seen = self.followers[h]
        alpha = (1 - sum(self.p(h, x) for x in seen)) / (1 - sum(self.p(h[1:], x) for x in seen))
        return alpha * self.p(h[1:], w)

    def score(self, t):
        w = ["<s>"] * (self.order - 1) + t
        return sum(math.log10(self.p(tuple(w[i - self.order + 1:i]), w[i])) for i in range(self.order - 1, len(w)))


@pytest.mark.parametrize(("order", "chunk", "keys"), [(1, 8 << 20, 1 << 21), (2, 400, 16), (3, 8 << 20, 1 << 21), (3, 400, 16), (4, 900, 64)])
def test_orders(spark, order, chunk, keys):
    rows = corpus()
    held = F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False))
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, level double")  # a clashing name
    got = lm_scoring.score_documents(docs, held, order=order, chunk_bytes=chunk, bucket_keys=keys).collect()
    tokens = [(i, [*(t or "").lower().split(), "</s>"], i is not None and i % 4 == 1) for i, t in rows]
    model = Brute([t for _, t, out in tokens if not out], order)
    vocabulary = [g[0] for g in model.counts[1]]
    for h in [("<s>",) * (order - 1), *list(model.context[order])[:20], ("a",) * (order - 1), ("b", "zz", "a")[-(order - 1):] if order > 1 else ()]:
        assert sum(model.p(h, w) for w in vocabulary) + model.p(h, "unknown!") == pytest.approx(1)
    want = sorted((str(i), out, len(t), sum((w,) in model.counts[1] for w in t), model.n, model.score(t)) for i, t, out in tokens)
    have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got)
    assert [x[:5] for x in have] == [x[:5] for x in want]
    assert [x[5] for x in have] == pytest.approx([x[5] for x in want], abs=1e-6)


def test_longer_contexts_tell_more(spark):
    r = random.Random(3)
    phrases = [" ".join(r.choices(WORDS, k=3)) for _ in range(12)]
    docs = spark.createDataFrame([(i, " ".join(r.choices(phrases, k=12))) for i in range(200)], "doc_id long, text string")
    held = F.col("doc_id") % 5 == 1
    total = [lm_scoring.score_documents(docs, held, order=m).where("held_out").agg(F.sum("score")).first()[0] for m in (1, 2, 3)]
    assert total[0] < total[1] < total[2]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scoring.score_documents(empty, F.col("doc_id") == 1, order=3).count() == 0
    one = spark.createDataFrame([(1, "a b"), (1, None)], "doc_id long, text string")
    untrained = lm_scoring.score_documents(one, F.lit(True), order=3).collect()
    assert [(r.n_tokens, r.score, r.train_tokens) for r in sorted(untrained, key=lambda r: r.n_tokens)] == [(1, 0.0, 0), (3, 0.0, 0)]
    with pytest.raises(ValueError, match="order"):
        lm_scoring.score_documents(one, F.lit(True), order=0)
