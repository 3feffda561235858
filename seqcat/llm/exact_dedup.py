"""Exact deduplication by Grace hashing.

Records are partitioned by the hash of their normalised text until each bucket fits in memory; then an
open-addressing table compares complete contents.  The levels are Spark's: bucket sizes are measured first,
a bucket beyond ``bucket_bytes`` is split by its next hash bits, again until all fit, and Spark's shuffle
files are the spill files, so a lost executor only repeats its tasks.  Each input task first combines its
own copies in such a table (flushed when full), so a text that a third of all rows share is
shuffled once per flush.  The copies that are left of a text with more than ``HOT_ROWS`` rows (or one in 2^19 of all
rows, so that the hot hashes fit a broadcast) are dealt to ``SALTS`` tables by their input task, whose groups
are summed up afterwards, so they don't gather in one bucket either.

Defined results: texts are equal when identical after lower-casing A-Z; null counts as empty; a null id is
smaller than any other; rows that repeat the id that stays all stay; an empty table gives an empty result;
extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqcat.llm.common import slices, staged

BUCKET_BYTES = 32 << 20
LEVEL_BITS = 10
HOT_ROWS = 1 << 16
SALTS = 256


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


class ContentTable:
    """Open addressing with linear probing; equal means equal complete content."""

    def __init__(self) -> None:
        self.places = [-1] * 64
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.best: list[int | None] = []
        self.counts: list[int] = []
        self.bytes = 0

    def add(self, h: int, text: bytes, doc_id: int | None, n: int) -> None:
        mask = len(self.places) - 1
        i = h & mask
        while (j := self.places[i]) >= 0:
            if self.hashes[j] == h and self.texts[j] == text:
                self.counts[j] += n
                if doc_id is not None and (self.best[j] is None or doc_id > self.best[j]):
                    self.best[j] = doc_id
                return
            i = (i + 1) & mask
        self.places[i] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.best.append(doc_id)
        self.counts.append(n)
        self.bytes += len(text) + 100
        if 3 * len(self.texts) > 2 * len(self.places):
            self._grow()

    def _grow(self) -> None:
        self.places = [-1] * (4 * len(self.places))
        mask = len(self.places) - 1
        for j, h in enumerate(self.hashes):
            i = h & mask
            while self.places[i] >= 0:
                i = (i + 1) & mask
            self.places[i] = j


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [normalised(t) for t in b.column("text").to_pylist()]
        yield pa.record_batch({
            "doc_id": b.column("doc_id"), "sha": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            "h": pa.array([signed(xxhash.xxh3_64_intdigest(t)) for t in texts], pa.int64()),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64())})


def _combine(limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(t: ContentTable) -> pa.RecordBatch:
            return pa.record_batch({"h": pa.array([signed(h) for h in t.hashes], pa.int64()), "content": pa.array(t.texts, pa.binary()),
                                    "best": pa.array(t.best, pa.int64()), "n": pa.array(t.counts, pa.int64())})
        seen = ContentTable()
        for b in slices(batches):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                content = normalised(text)
                seen.add(xxhash.xxh3_64_intdigest(content), content, doc_id, 1)
            if seen.bytes > limit:
                yield rows(seen)
                seen = ContentTable()
        yield rows(seen)
    return run


def _resolve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and salt -> one row per distinct content with copies, or with a salt; one table at a time."""
    def groups(t: ContentTable) -> pa.RecordBatch:
        many = [j for j, n in enumerate(t.counts) if n > 1 or at[1]]
        return pa.record_batch({"sha": pa.array([hashlib.sha256(t.texts[j]).digest() for j in many], pa.binary()),
                                "keep_id": pa.array([t.best[j] for j in many], pa.int64()),
                                "group_size": pa.array([t.counts[j] for j in many], pa.int64())})
    at, seen = (None, 0), ContentTable()
    for b in slices(batches, "content"):
        for *key, h, text, best, n in zip(*(b.column(c).to_pylist() for c in ("bucket", "salt", "h", "content", "best", "n")), strict=True):
            if tuple(key) != at:
                yield groups(seen)
                at, seen = tuple(key), ContentTable()
            seen.add(h & (1 << 64) - 1, text, best, n)
    yield groups(seen)


def bucketed(sizes: DataFrame, bucket_bytes: int = BUCKET_BYTES, bits: int = LEVEL_BITS) -> tuple[object, int]:
    """From (h, n_bytes) of the distinct contents: a column that gives a hash's bucket, and the levels used.

    Level k takes the first ``k * bits`` bits of the hash.  Levels are added until no bucket exceeds
    ``bucket_bytes`` or one hash is left in it; a bucket that fits at a level stays at the finer one.
    """
    levels = 0
    while True:
        levels += 1
        bucket = F.shiftrightunsigned(F.col("h"), 64 - levels * bits)
        if (levels + 1) * bits > 64:
            return bucket, levels
        sums = sizes.groupBy(bucket.alias("bucket")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        if not sums.where((F.col("b") > bucket_bytes) & (F.col("n") > 1)).take(1):
            return bucket, levels


def exact_groups(docs: DataFrame, digests: DataFrame, bucket_bytes: int = BUCKET_BYTES, bits: int = LEVEL_BITS,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """(sha, keep_id, group_size) of every content that two rows or more share."""
    sizes = digests.groupBy("h").agg(F.max("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows"))
    bucket, _ = bucketed(sizes, bucket_bytes, bits)
    hot = staged(sizes.where(F.col("n_rows") > max(hot_rows, digests.count() >> 19)).select("h", F.lit(True).alias("hot")), "exact-hot")
    local = docs.select("doc_id", "text").mapInArrow(_combine(bucket_bytes), "h long, content binary, best long, n long")
    salt = F.when(F.col("hot"), 1 + F.spark_partition_id() % SALTS).otherwise(0)
    local = local.join(F.broadcast(hot), "h", "left").withColumn("bucket", bucket).withColumn("salt", salt).drop("hot")
    found = (local.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt")
             .mapInArrow(_resolve, "sha binary, keep_id long, group_size long"))
    return found.groupBy("sha").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")).where(
        F.col("group_size") > 1)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_bytes: int = BUCKET_BYTES, bits: int = LEVEL_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    digests = staged(docs.mapInArrow(_digests, "doc_id long, sha binary, h long, n_bytes long"), "digests")
    groups = staged(exact_groups(docs, digests, bucket_bytes, bits, hot_rows), "exact-groups")
    joined = digests.join(groups, "sha", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def op3_exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return exact_dedup(docs)


ORACLE = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM d
"""
