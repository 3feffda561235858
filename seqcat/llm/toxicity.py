"""Toxicity by a linear-chain conditional random field over words.

Fitting takes a bounded sample of labelled documents (``SAMPLE_DOCS`` by label, texts up to
``SAMPLE_CHARS``).  Document labels become token labels: a word in a toxic document is labelled toxic when it, or
a prefix of it, occurs in toxic sample documents far more than in clean ones (log-likelihood ratio).  From these
labelled tokens the field learns weights of hashed word features and of the four transitions by its
conditional likelihood; forward-backward gives the gradients.  Logistic regression on sums of marginals gives the
document score.

Scoring is row by row: forward-backward over the whole text, marginals summed to a score, and the offsets of
runs of words that are more likely toxic than not.  The model has a fixed size (``1 << FEATURE_BITS``
weights), whatever the data.

Defined results: a null or empty text has no words, no spans and the score of no evidence; a null id counts as
training data only if labelled, which it can't be; null labels are ignored, of several labels of a document the
largest counts; without labelled rows of both kinds the score is the share of toxic labels (0 without any);
repeated rows get the same score; extra columns are kept, ``toxicity`` replaces a column of that name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqcat.llm.common import SLICE_BYTES, aside, held_out, staged, table
from seqcat.llm.decontaminate import words as plain_words

SAMPLE_DOCS = (3000, 1500)  #: clean and toxic
SAMPLE_CHARS = 8000
FEATURE_BITS = 18
MIN_RATIO = 8.0  #: log-likelihood ratio from which a word or prefix marks toxic tokens
STEPS = 40
FIT_TOKENS = 1 << 16  #: tokens of whole texts that a step of fitting holds at a time, beside a few numbers a token
RESULT = "score double, spans array<struct<start:int,end:int>>"
_PREFIXES = (3, 4, 5, 6)
_CACHE = 1 << 20


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits."""
    return plain_words(text.lower()) if text else []


def parts(word: bytes) -> list[bytes]:
    """The word and its prefixes."""
    return [word, *(word[:k] + b"*" for k in _PREFIXES if len(word) > k)]


def feature_ids(word: bytes) -> list[int]:
    return [zlib.crc32(p) >> (32 - FEATURE_BITS) for p in parts(word)]


def scan(m00, m01, m10, m11, first: float) -> np.ndarray:
    """Ratios r(t) = (m01 + m11 r(t-1)) / (m00 + m10 r(t-1)): blocks are composed, then run side by side."""
    n = len(m00)
    steps = max(1, math.isqrt(n))
    blocks = -(-n // steps)
    pad = blocks * steps - n
    m = [np.ascontiguousarray(np.concatenate([x, np.full(pad, fill)]).reshape(blocks, steps).T)
         for x, fill in ((m00, 1.0), (m01, 0.0), (m10, 0.0), (m11, 1.0))]
    p00, p01, p10, p11 = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(steps):
        a, b, c, d = m[0][t], m[1][t], m[2][t], m[3][t]
        p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
        if t % 4 == 3:
            total = p00 + p01 + p10 + p11
            p00, p01, p10, p11 = p00 / total, p01 / total, p10 / total, p11 / total
    starts, r = np.empty(blocks), first
    for i, (a, b, c, d) in enumerate(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist(), strict=True)):
        starts[i] = r
        r = (b + d * r) / (a + c * r)
    out, r = np.empty((steps, blocks)), starts
    for t in range(steps):
        r = (m[1][t] + m[3][t] * r) / (m[0][t] + m[2][t] * r)
        out[t] = r
    return out.T.reshape(-1)[:n]


def forward_backward(scores: np.ndarray, starts: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic label, and expected transition counts (2 x 2), of sequences laid end to end.

    ``scores`` are log weights of toxic against clean; ``starts`` the places of the first tokens.
    """
    n = len(scores)
    t = np.exp(trans)
    e = np.exp(np.clip(scores, -30, 30))
    new = np.zeros(n, dtype=bool)
    new[starts] = True
    last = np.append(new[1:], True)
    a = scan(np.where(new, 1.0, t[0, 0]), np.where(new, e, t[0, 1] * e), np.where(new, 1.0, t[1, 0]), np.where(new, e, t[1, 1] * e), 1.0)
    after = np.append(e[1:], 1.0)
    back = [np.where(last, 1.0, x)[::-1] for x in (t[0, 0] + 0 * e, t[1, 0] + 0 * e, t[0, 1] * after, t[1, 1] * after)]
    b = scan(*back, 1.0)[::-1]
    p = a * b / (1 + a * b)
    before, eb = a[:-1][~new[1:]], (e * b)[1:][~new[1:]]
    w = np.array([t[0, 0] + 0 * eb, t[0, 1] * eb, t[1, 0] * before, t[1, 1] * before * eb])
    return p, (w / w.sum(axis=0)).sum(axis=1).reshape(2, 2)


@dataclass
class Field:
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    logistic: np.ndarray  #: weights of the document features
    share: float | None = None  #: of toxic labels, when there is nothing to learn from

    def tag(self, texts: list[list[bytes]], known: dict[bytes, float]) -> list[np.ndarray]:
        """Marginals per text."""
        if len(known) > _CACHE:
            known.clear()
        flat = [w for ws in texts for w in ws]
        for w in set(flat).difference(known):
            known[w] = self.bias + float(self.weights[feature_ids(w)].sum())
        if not flat:
            return [np.zeros(0)] * len(texts)
        lengths = np.array([len(ws) for ws in texts])
        ends = np.cumsum(lengths)
        starts = (ends - lengths)[lengths > 0]
        p, _ = forward_backward(np.fromiter(map(known.__getitem__, flat), dtype=float, count=len(flat)), starts, self.trans)
        return np.split(p, ends[:-1])

    def score(self, marginals: np.ndarray) -> float:
        if self.share is not None:
            return self.share
        return float(1 / (1 + math.exp(-np.clip(document_features(marginals) @ self.logistic, -30, 30))))


def document_features(p: np.ndarray) -> np.ndarray:
    total = float(p.sum())
    return np.array([1.0, math.log1p(total), float(p.max()) if len(p) else 0.0, math.log1p(float((p >= 0.5).sum())),
                     1000 * total / (len(p) + 100) / 10])


def seeds(texts: Iterable[Iterable[bytes]], toxic: list[bool]) -> set[bytes]:
    """Words and prefixes that occur in toxic documents far more often than chance gives."""
    found = [Counter(), Counter()]
    for ws, y in zip(texts, toxic, strict=True):
        found[y].update({p for w in set(ws) for p in parts(w)})
    share = sum(toxic) / len(toxic)
    out = set()
    for p, k in found[1].items():
        n = k + found[0][p]
        q = k / n
        ratio = k * math.log(q / share) + ((n - k) * math.log((1 - q) / (1 - share)) if n > k else 0.0)
        if q > share and q > 0.9 and ratio >= MIN_RATIO:
            out.add(p)
    return out


def fit(rows: list[tuple[str | None, int]], share: float | None = None, steps: int = STEPS) -> Field:
    """The field learnt from (text, toxic) rows; ``share`` is the share of toxic labels where the rows come from,
    by which the document score is weighted."""
    rows = list(dict.fromkeys((t or "", int(y)) for t, y in rows))
    toxic = [y > 0 for _, y in rows]
    size = 1 << FEATURE_BITS
    trans = np.zeros((2, 2))
    if not rows or len(set(toxic)) < 2:
        own = sum(toxic) / len(toxic) if rows else 0.0
        return Field(np.zeros(size), 0.0, trans, np.zeros(5), own if share is None else share)
    vocabulary: dict[bytes, int] = {}  # texts are kept as places in it
    texts = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words(t)], dtype=np.int32) for t, _ in rows]
    spelt = list(vocabulary)
    marks = seeds(([spelt[i] for i in np.unique(ws)] for ws in texts), toxic)
    marked = np.array([any(p in marks for p in parts(w)) for w in vocabulary], dtype=bool)
    feats = [feature_ids(w) for w in vocabulary]
    feat, owner = np.array([f for fs in feats for f in fs]), np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    flat = np.concatenate(texts)
    lengths = np.array([len(ws) for ws in texts])
    ends = np.cumsum(lengths)
    labels = marked[flat] & np.repeat(toxic, lengths)
    new = np.zeros(len(flat), dtype=bool)
    new[(ends - lengths)[lengths > 0]] = True
    pairs = (2 * labels[:-1] + labels[1:])[~new[1:]]
    seen = np.bincount(pairs, minlength=4).reshape(2, 2)
    weights, bias = np.zeros(size), -4.0
    cuts = [0, *ends[np.flatnonzero(np.diff(ends // FIT_TOKENS))].tolist(), len(flat)]  # between texts

    def marginals() -> tuple[np.ndarray, np.ndarray]:
        by_word = bias + np.bincount(owner, weights=weights[feat], minlength=len(feats))
        p, expected = np.zeros(len(flat)), np.zeros((2, 2))
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                p[i:j], part = forward_backward(by_word[flat[i:j]], np.flatnonzero(new[i:j]), trans)
                expected += part
        return p, expected

    sums = [np.full(size, 1e-8), 1e-8, np.full((2, 2), 1e-8)]  # Adagrad
    for _ in range(steps):
        p, expected = marginals()
        error = labels - p
        grads = [np.bincount(feat, weights=np.bincount(flat, weights=error, minlength=len(feats))[owner], minlength=size) - 0.01 * weights,
                 error.sum(), seen - expected - 0.01 * trans]
        sums = [s + g * g for s, g in zip(sums, grads, strict=True)]
        weights, bias, trans = (x + 0.5 * g / np.sqrt(s) for x, g, s in zip((weights, bias, trans), grads, sums, strict=True))
    field = Field(weights, float(bias), trans, np.zeros(5))
    x = np.array([document_features(m) for m in np.split(marginals()[0], ends[:-1])])
    y = np.array(toxic, dtype=float)
    share = y.mean() if share is None else share
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta = np.zeros(x.shape[1])
    for _ in range(25):  # Newton's method with a ridge
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(hessian, x.T @ (weight * (y - q)) - 0.5 * beta)
    field.logistic = beta
    return field


def labelled_sample(docs: DataFrame, labels: DataFrame, keep=None,
                    sample: tuple[int, int] = SAMPLE_DOCS) -> tuple[list[tuple[str | None, int]], float | None]:
    """At most ``sample`` (text, toxic) rows by label of texts up to ``SAMPLE_CHARS``, by a fixed hash order, and the share of toxic labels;
    ids that ``keep`` refuses are never read.  The sampled ids are broadcast, so documents aren't shuffled."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    if keep is not None:
        ids = ids.where(keep)
    share = ids.agg(F.avg("toxic")).first()[0]
    short = docs.where(F.length("text") <= SAMPLE_CHARS)
    ids = staged(ids.join(short.select("doc_id"), "doc_id", "left_semi"), "toxicity-ids")
    by_label = [ids.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in enumerate(sample)]
    rows = short.select("doc_id", "text").join(F.broadcast(by_label[0].union(by_label[1])), "doc_id")
    # repeated rows of an id can't grow the sample
    rows = rows.select("text", "toxic").distinct().orderBy(F.xxhash64("text"), "text").limit(sum(sample))
    return [(r["text"], r["toxic"]) for r in rows.collect()], share


def scored(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """All columns and ``toxicity``: the score and the offending (start, end) offsets in code points."""
    model = docs.sparkSession.sparkContext.broadcast(vars(field))
    word = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, float] = {}
        crf = Field(**model.value)
        for texts in batches:
            texts = [t if isinstance(t, str) else "" for t in texts]
            out, i = [], 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= SLICE_BYTES):
                    size += len(texts[j])
                    j += 1
                for t, p in zip(texts[i:j], crf.tag([words(t) for t in texts[i:j]], known), strict=True):
                    spans = []
                    if len(p) and p.max() >= 0.5:
                        at = [m.span() for m in word.finditer(t)]
                        on = np.flatnonzero(np.diff(np.concatenate([[False], p >= 0.5, [False]])))
                        spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in on.reshape(-1, 2)]
                    out.append((crf.score(p), spans))
                i = j
            yield pd.DataFrame(out, columns=["score", "spans"])
    return docs.withColumn("toxicity", run(F.col(text_col)))


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Field:
    """The field learnt from labels of rows that aren't held out."""
    return fit(*labelled_sample(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 0)))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, unchanged."""
    docs, columns = aside(docs, "toxicity")
    return scored(docs, fitted(spark, docs, sf_dir)).where(F.col("toxicity.score") < 0.5).select(*columns)


def op4_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select("doc_id", "text")
    out = scored(docs, fitted(spark, docs, sf_dir))
    return out.select("doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), F.col("toxicity.score").alias("score"),
                      (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"))
