"""Language-model scoring: a Katz backoff model of any order, learned and evaluated on chunks of documents.

Probability of a token w after its context h, the m - 1 tokens before it (before a document stand start marks):

* order m > 1: P(w | h) = d(r) r / c(h) when h w was seen r > 0 times in training, else alpha(h) P(w | h'), where
  h' is h without its first token;
* order 1: P(w) = d1(c) c / N when the word was seen, else the mass that the discounts of seen words leave;
* alpha(h) = (1 - sum of P(w | h) over seen h w) / (1 - sum of P(w | h') over the same words), so that each
  distribution sums to one exactly; an h that was never seen has alpha 1.

d are Good-Turing discounts of an order for counts up to ``K`` (Katz's formula, from counts of counts); larger counts
give up ``TOP / r``, so no context is left without mass.  Where counts of counts are degenerate the discount is
absolute; a model without left-over mass for unknown words adds ``ADD`` to each count in the base.

A sequence seen in training has its shorter ends seen too.  So the recursion from the highest order down stops at the
first order that knows the token, and the sums behind alpha take counts only: all orders are counted in one round,
all alpha found in a second one.

A chunk of documents is one stored row: the hashes of its distinct words and its tokens as numbers into
them.  It asks for the training counts of its distinct sequences of 1 to ``order`` tokens in sorted, packed arrays
dealt by bucket of the key; a bucket sums what all chunks say and answers each with the totals.  Every
distinct sequence has one owner among the chunks, which adds its term to the sums of its context; these are
summed by bucket again and give alpha.  The tables of requests and answers are stored, partitioned
by chunk; a hot word or pair is one entry per chunk.  Requests are (chunks x buckets) rows, a few hundred
keys each at 30 GB.  Buckets, and the tasks that chunks are dealt to, grow with the input.

Defined results: null and empty texts are one end token; a null id counts as training; repeated rows count
each; no training rows give every token the unknown word's mass, one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat.llm.common import held_out, slices, space_words, staged
from seqcat.llm.near_dedup import WordHashes

CHUNK_BYTES = 8 << 20
BUCKET_KEYS = 1 << 21
ORDER = 2
CHUNKS_PER_TASK = 8
K = 5
TOP = 0.05
ADD = 0.5
_END, _START = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_U64 = np.uint64


def pack(x: np.ndarray) -> bytes:
    """Byte planes, compressed; 8-byte numbers only."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes, n: int, kind=np.int64) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, decompressed_size=8 * n, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=_U64(0)))


def unpack_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(blob, n, np.uint64), dtype=np.uint64)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = (first ^ (first >> _U64(31))) * _U64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> _U64(29))) * _U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U64(32))


def _chunks(chunk_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashed, part, made, size = WordHashes(), TaskContext.get().partitionId(), 0, 0
        ids, held, lengths, tokens = [], [], [], []

        def row() -> pa.RecordBatch:
            words, places = np.unique(np.concatenate(tokens), return_inverse=True)
            return pa.record_batch({
                "chunk": pa.array([part << 32 | made], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "held": pa.array([held], pa.list_(pa.bool_())), "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "n_words": pa.array([len(words)], pa.int64()), "n_tokens": pa.array([len(places)], pa.int64()),
                "words": pa.array([pack_keys(words)], pa.binary()), "tokens": pa.array([pack(places.astype(np.int64))], pa.binary())})

        for b in slices(batches):
            for doc_id, out, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held", "text")), strict=True):
                ws = space_words(text)
                tokens.append(np.append(hashed(ws), _END))
                ids.append(doc_id)
                held.append(out)
                lengths.append(len(ws) + 1)
                size += 8 + len((text or "").encode("utf-8", "surrogatepass"))
                if size >= chunk_bytes:
                    yield row()
                    made, size = made + 1, 0
                    ids, held, lengths, tokens = [], [], [], []
        if ids:
            yield row()
    return run


class Sequences:
    """A chunk's token sequences of one length: distinct ``keys`` in order, the first place ``at`` of each, each
    place's number ``own``; and each place's context as a number into ``contexts`` (the last one: the start)."""

    def __init__(self, contexts: np.ndarray, before: np.ndarray, words: np.ndarray) -> None:
        self.contexts, self.before = contexts, before
        self.keys, self.at, self.own = np.unique(pair_keys(contexts[before], words), return_index=True, return_inverse=True)


class Chunk:
    """A chunk's arrays: tokens, and their sequences of two tokens and more."""

    def __init__(self, row: dict, order: int) -> None:
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.held = np.array(row["held"], dtype=bool)
        self.words = unpack_keys(row["words"], row["n_words"])
        self.tokens = unpack(row["tokens"], row["n_tokens"])
        self.train = np.repeat(~self.held, self.lengths)
        self.longer: list[Sequences] = []
        keys, own = self.words, self.tokens
        for _ in range(1, order):
            before = np.concatenate([[len(keys)], own[:-1]])
            before[self.starts] = len(keys)
            self.longer.append(Sequences(np.append(keys, _START), before, self.words[self.tokens]))
            keys, own = self.longer[-1].keys, self.longer[-1].own

    def levels(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(length, keys, each place's number) of every length of sequences."""
        return [(1, self.words, self.tokens), *((m, q.keys, q.own) for m, q in enumerate(self.longer, 2))]


def _dealt(chunk: int, level: int, bits: int, keys: np.ndarray, n_columns: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket (leading bits) of sorted keys."""
    edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << _U64(64 - bits)) if bits else []
    edges = [0, *edges, len(keys)]
    parts = [(b, s, e) for b, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if e > s]
    out = {"level": pa.array([level] * len(parts), pa.int32()), "bucket": pa.array([b for b, _, _ in parts], pa.int64()),
           "chunk": pa.array([chunk] * len(parts), pa.int64()), "n": pa.array([int(e - s) for _, s, e in parts], pa.int64()),
           "keys": pa.array([pack_keys(keys[s:e]) for _, s, e in parts], pa.binary())}
    for i in range(n_columns):
        out[f"x{i}"] = pa.array([pack(columns[i][s:e]) for _, s, e in parts], pa.binary())
    return pa.record_batch(out)


def _by_chunk(of_chunk):
    """A ``mapInArrow`` function that handles chunk rows one by one; what a row needed is freed before the next."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from of_chunk(b.slice(i, 1).to_pylist()[0])
    return run


def _requests(bits: list[int]):
    def asked(row: dict) -> Iterator[pa.RecordBatch]:
        c = Chunk(row, len(bits))
        for m, keys, own in c.levels():
            yield _dealt(row["chunk"], m, bits[m - 1], keys, 1, [np.bincount(own[c.train], minlength=len(keys))])
    return _by_chunk(asked)


def _gather(group: pd.DataFrame):
    """All keys of a bucket: distinct number of each entry, and the ends of the chunks' parts."""
    group = group.sort_values("chunk", kind="stable")
    keys = np.concatenate([unpack_keys(k, n) for k, n in zip(group["keys"], group["n"], strict=True)])
    _, place = np.unique(keys, return_inverse=True)
    return group, place, np.cumsum(group["n"].to_numpy())


def _tally(group: pd.DataFrame) -> pd.DataFrame:
    """Training totals for each chunk's keys (twice the total, plus one for the owner of a seen key), and in
    a row without chunk the number of keys by count up to K + 1, all keys and all occurrences."""
    group, place, ends = _gather(group)
    counts = np.concatenate([unpack(x, n) for x, n in zip(group["x0"], group["n"], strict=True)])
    totals = np.bincount(place, weights=counts).astype(np.int64)
    answer = 2 * totals[place]
    seen = np.flatnonzero(counts > 0)
    answer[seen[np.unique(place[seen], return_index=True)[1]]] += 1
    level = int(group["level"].iloc[0])
    out = [(level, int(b), int(c), int(n), pack(answer[e - n:e]), None)
           for b, c, n, e in zip(group["bucket"], group["chunk"], group["n"], ends, strict=True)]
    by_count = np.bincount(np.minimum(totals, K + 2), minlength=K + 3)
    out.append((level, int(group["bucket"].iloc[0]), None, 0, None, [*by_count[1:K + 2].tolist(), int((totals > 0).sum()), int(totals.sum())]))
    return pd.DataFrame(out, columns=["level", "bucket", "chunk", "n", "answer", "stats"])


def discounts(counts_of_counts: list[int]) -> list[float]:
    """Katz's Good-Turing discounts of the counts 1..K from the numbers of keys seen 1..K+1 times."""
    n = [0, *counts_of_counts]
    share = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share) if n[r] and n[r + 1] and share < 1 else 0.0
        out.append(d if 0 < d < 1 else 1 - 0.5 / r)
    return out


def discounted(r: np.ndarray, d: list[float]) -> np.ndarray:
    """d(r) * r."""
    return np.where(r <= K, np.array([0.0, *d])[np.minimum(r, K)] * r, r - TOP)


class Unigrams:
    """P(word) by its training count."""

    def __init__(self, counts_of_counts: list[int], n_words: int, n_tokens: int) -> None:
        self.d, self.v, self.n = discounts(counts_of_counts), n_words, n_tokens
        self.left = 0.0  #: mass of the unknown word
        if n_tokens:
            low = sum(r * c for r, c in enumerate(counts_of_counts[:K], 1))
            kept = sum(r * c * d for r, (c, d) in enumerate(zip(counts_of_counts[:K], self.d, strict=False), 1))
            high = n_words - sum(counts_of_counts[:K])
            self.left = (low - kept + TOP * high) / n_tokens
        else:
            self.left = 1.0

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d) / max(self.n, 1), self.left)

    def base(self, c: np.ndarray) -> np.ndarray:
        return (c + ADD) / (self.n + ADD * (self.v + 1))


def _parts(parts: list[dict], level: int, kind=np.int64) -> np.ndarray:
    own = sorted((p for p in parts if p["level"] == level), key=lambda p: p["bucket"])
    return np.concatenate([np.zeros(0, dtype=kind), *(unpack(p["answer"], p["n"], kind) for p in own)])


def _partial(unigrams: Unigrams, d: list[list[float]], n_docs: int, bits: list[int]):
    """Chunks with their totals -> scores without the backoff weights, and the sums that make these.  ``d``: the
    discounts of sequences of two tokens and more."""
    def scored(row: dict) -> Iterator[pa.RecordBatch]:
        c = Chunk(row, len(bits))
        total = lambda x: np.add.reduceat(x, c.starts)
        r1 = _parts(row["parts"], 1) // 2
        lower, r, own = unigrams(r1), r1, c.tokens
        logs = np.log10(lower)[own]
        sums, places, uses, n_asked = [], [], [], 0
        for m, (q, d_m) in enumerate(zip(c.longer, d, strict=True), 2):
            answer, seen = _parts(row["parts"], m), np.append(r, n_docs)  # a context's followers: its occurrences
            r, mine, ctx = answer // 2, answer % 2 == 1, q.before[q.at]
            known = r > 0
            p = np.where(known, discounted(r, d_m) / np.maximum(seen[ctx], 1), 1.0)
            num, den = (np.bincount(ctx[mine], weights=x[mine], minlength=len(q.contexts)) for x in (p, lower[own[q.at]]))
            back = np.flatnonzero(~known[q.own] & (seen[q.before] > 0))
            need = np.zeros(len(q.contexts), dtype=bool)
            need[ctx[mine]] = need[q.before[back]] = True
            asked = np.flatnonzero(need)
            asked = asked[np.argsort(q.contexts[asked])]
            place = np.zeros(len(q.contexts), dtype=np.int64)
            place[asked] = np.arange(n_asked, n_asked + len(asked))
            n_asked += len(asked)
            sums.append(_dealt(row["chunk"], m, bits[m - 2], q.contexts[asked], 2, [num[asked], den[asked]]))
            places.append(back)
            uses.append(place[q.before[back]])
            logs, lower, own = np.where(known[q.own], np.log10(p)[q.own], logs), p, q.own
        back, used = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (places, uses))
        docs = {"doc_ids": row["doc_ids"], "held": row["held"], "lengths": row["lengths"],
                "n_known": total((r1[c.tokens] > 0).astype(np.int64)).tolist(),
                "base": total(np.log10(unigrams.base(r1))[c.tokens]).tolist(), "partial": total(logs).tolist(),
                "n_back": total(np.bincount(back, minlength=len(c.tokens))).tolist()}
        kinds = {"held": pa.bool_(), "base": pa.float64(), "partial": pa.float64()}
        head = {"level": pa.array([0], pa.int32()), "bucket": pa.array([0], pa.int64()), "chunk": pa.array([row["chunk"]], pa.int64()),
                "n": pa.array([len(back)], pa.int64()),
                "keys": pa.array([pack(used[np.argsort(back, kind="stable")])], pa.binary()),
                "x0": pa.array([None], pa.binary()), "x1": pa.array([None], pa.binary())}
        yield pa.record_batch(head | {k: pa.array([v], pa.list_(kinds.get(k, pa.int64()))) for k, v in docs.items()})
        for out in sums:
            yield pa.record_batch({k: out.column(k) for k in head} | {
                k: pa.array([None] * out.num_rows, pa.list_(kinds.get(k, pa.int64()))) for k in docs})
    return _by_chunk(scored)


def _alphas(group: pd.DataFrame) -> pd.DataFrame:
    """log10 of the backoff weight for each chunk's contexts."""
    group, place, ends = _gather(group)
    num, den = (np.bincount(place, weights=np.concatenate([unpack(x, n, np.float64) for x, n in zip(group[c], group["n"], strict=True)]))
                for c in ("x0", "x1"))
    logs = np.log10(np.maximum(1 - num, 1e-300) / np.maximum(1 - den, 1e-300))[place]
    level = int(group["level"].iloc[0])
    return pd.DataFrame([(level, int(b), int(c), int(n), pack(logs[e - n:e])) for b, c, n, e in zip(
        group["bucket"], group["chunk"], group["n"], ends, strict=True)], columns=["level", "bucket", "chunk", "n", "answer"])


def _scores(order: int):
    def summed(row: dict) -> Iterator[pa.RecordBatch]:
        alphas = np.concatenate([np.zeros(0), *(_parts(row["parts"] or [], m, np.float64) for m in range(2, order + 1))])
        back = np.concatenate([[0.0], np.cumsum(alphas[unpack(row["keys"], row["n"])])]) if row["n"] else np.zeros(1)
        n_back = np.array(row["n_back"], dtype=np.int64)
        ends = np.cumsum(n_back)
        yield pa.record_batch({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
            "n_tokens": pa.array(row["lengths"], pa.int64()), "n_known": pa.array(row["n_known"], pa.int64()),
            "base_score": pa.array(row["base"], pa.float64()),
            "score": pa.array(np.array(row["partial"]) + back[ends] - back[ends - n_back], pa.float64())})
    return _by_chunk(summed)


def _spread(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to n tasks where that is more than Spark would take."""
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _answers(answers: DataFrame) -> DataFrame:
    """(chunk, parts): a chunk's own answers together."""
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("level", "bucket", "n", "answer")).alias("parts"))


def score_documents(docs: DataFrame, is_held_out, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; ``order``: tokens that the
    longest counted sequences have."""
    if order < 1:
        raise ValueError("order must be at least 1")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out.alias("held"), F.col(text_col).alias("text"))
    chunks = staged(docs.mapInArrow(_chunks(chunk_bytes), (
        "chunk long, doc_ids array<long>, held array<boolean>, lengths array<long>, n_words long, n_tokens long, words binary, "
        "tokens binary")), "lm-chunks")
    n_words, n_tokens, n_docs, n_chunks = chunks.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0)),
        F.coalesce(F.sum(F.size(F.filter("held", lambda x: ~x))), F.lit(0)), F.count(F.lit(1))).first()
    bits = [max(0, math.ceil(math.log2(max(1, n) / bucket_keys))) for n in [n_words, *[n_tokens] * (order - 1)]]
    n_buckets, n_tasks = sum(1 << b for b in bits), -(-n_chunks // CHUNKS_PER_TASK)
    asked = chunks.mapInArrow(_requests(bits), "level int, bucket long, chunk long, n long, keys binary, x0 binary")
    told = staged(_spread(asked, n_buckets, "level", "bucket").groupBy("level", "bucket").applyInPandas(
        lambda g: _tally(g), "level int, bucket long, chunk long, n long, answer binary, stats array<long>"), "lm-counts")
    stats = {r["level"]: list(r)[1:] for r in told.where("chunk is null").groupBy("level").agg(
        *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(K + 3)]).collect()}  # a row an order
    one, *more = (stats.get(m, [0] * (K + 3)) for m in range(1, order + 1))
    unigrams = Unigrams(one[:K + 1], one[K + 1], one[K + 2])
    answers = _answers(_spread(told.where("chunk is not null"), n_tasks, "chunk"))
    partial = staged(chunks.join(answers, "chunk").mapInArrow(
        _partial(unigrams, [discounts(x[:K + 1]) for x in more], n_docs, bits), (
            "level int, bucket long, chunk long, n long, keys binary, x0 binary, x1 binary, doc_ids array<long>, "
            "held array<boolean>, lengths array<long>, n_known array<long>, base array<double>, partial array<double>, n_back array<long>")),
        "lm-partial")
    sums = partial.where("level > 0").select("level", "bucket", "chunk", "n", "keys", "x0", "x1")
    alphas = _spread(sums, n_buckets, "level", "bucket").groupBy("level", "bucket").applyInPandas(
        lambda g: _alphas(g), "level int, bucket long, chunk long, n long, answer binary")
    rows = partial.where("level = 0").drop("level", "bucket", "x0", "x1").join(_answers(_spread(alphas, n_tasks, "chunk")), "chunk", "left")
    out = rows.mapInArrow(_scores(order), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(unigrams.n).cast("long").alias("train_tokens"),
                      "base_score", "score")


def op10_lm_scoring(docs: DataFrame) -> DataFrame:
    return score_documents(docs, held_out(F.col("doc_id"), 1))
