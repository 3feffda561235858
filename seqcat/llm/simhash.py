"""SimHash near duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; documents link when theirs differ in ``RADIUS`` bits at most.  Every distinct
fingerprint stands for all variants of itself within half the radius.  Two fingerprints that share a variant are
within the radius of each other, and any two within the radius share one: they meet in the middle.

The variants (2081 of each fingerprint at radius 4) are shuffled by bucket, a run of their leading bits.  A
fingerprint is sent once to each bucket that holds variants of it, with the changes it has left, and its
variants are written out there and nowhere else; so the shuffle carries dozens of rows a fingerprint, not
thousands.  The number of leading bits grows with the number of fingerprints, and a bucket whose
variants still exceed ``BUCKET_VARIANTS`` is dealt out again by its next bits, until all fit.  Inside a bucket
the variants are sorted, equal ones collide, collisions are verified by their differing bits, and what
they join is handed on as a star, never as all pairs.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer words than a shingle is one
shingle; null, empty and blank texts have fingerprint zero and are linked like any other; a bit set in exactly half the
hashes is 0; null ids count as larger than all others (a component of null ids only has a null id); repeated rows share a
fingerprint; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqcat.llm.common import broadcast_if_small, slices, sorted_groups, space_words, staged
from seqcat.llm.graph import Forest, components

BITS = 64
SHINGLE = 4
SEED = 42
RADIUS = 4
BUCKET_VARIANTS = 1 << 21  #: variants written out at a time
MORE_BITS = 4  #: by which a bucket with more is dealt out again
HASH_BLOCK = 1 << 14

_BIT = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(words: list[bytes], n: int = SHINGLE) -> int:
    """The bits that are set in over half of the shingles' hashes."""
    if not words:
        return 0
    text = b" ".join(words)
    n = min(n, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:len(words) - n])).tolist()
    stops = (ends[n - 1:] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(starts), HASH_BLOCK):
        h = np.array([digest(text[a:z], SEED) for a, z in zip(starts[i:i + HASH_BLOCK], stops[i:i + HASH_BLOCK], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BIT[2 * counts > len(starts)].sum(dtype=np.uint64))


def _fingerprints(n: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        fps = np.array([fingerprint(space_words(t), n) for t in b.column("text").to_pylist()], dtype=np.uint64)
        yield pa.record_batch({"doc_id": b.column("doc_id"), "fp": pa.array(fps.view(np.int64), pa.int64())})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(partial(_fingerprints, n), "doc_id long, fp long")


def variant_count(bits: int, changes: int) -> int:
    return sum(math.comb(bits, k) for k in range(changes + 1))


def _masks(bits: int, changes: int) -> list[tuple[int, int]]:
    """(mask, changes left) of every way to change at most ``changes`` of ``bits`` bits."""
    out, last = [(0, changes)], [(0, 0)]
    for left in range(changes - 1, -1, -1):
        last = [(mask | 1 << i, i + 1) for mask, first in last for i in range(first, bits)]
        out += [(mask, left) for mask, _ in last]
    return out


def dealt(rows: DataFrame, level: int, more: int) -> DataFrame:
    """Rows (fp, bucket of ``level`` leading bits, left) dealt out by ``more`` further bits; ``left`` says how many changes
    a fingerprint may still make behind the bucket's bits."""
    next_bits = F.shiftright(F.shiftleft("fp", level), BITS - more).bitwiseAND((1 << more) - 1)
    top = rows.agg(F.max("left")).first()[0] if level else RADIUS // 2
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(top - left).alias("cost")) for m, left in _masks(more, top)])
    out = rows.withColumn("x", F.explode(F.filter(masks, lambda m: m["cost"] <= F.col("left"))))
    return out.select("fp", F.shiftleft("bucket", more).bitwiseOR(next_bits.bitwiseXOR(F.col("x.m"))).alias("bucket"),
                      (F.col("left") - F.col("x.cost")).alias("left"))


def _weight(level: int, changes: int) -> Column:
    """Variants that a row has in its bucket."""
    sizes = [variant_count(BITS - level, c) for c in range(changes + 1)]
    return F.element_at(F.array(*map(F.lit, sizes)), F.col("left").cast("int") + 1).cast("long")


def buckets(nodes: DataFrame, radius: int = RADIUS, bucket_variants: int = BUCKET_VARIANTS, more: int = MORE_BITS) -> list[tuple[int, DataFrame]]:
    """(bits, rows) of every level: the rows of buckets that fit at this level, and of no coarser one."""
    half, n = radius // 2, nodes.count()
    level = min(20, max(more, math.ceil(math.log2(max(1, 2 * n * variant_count(BITS, half) / bucket_variants)))))
    rows = nodes.select("fp", F.lit(0).cast("long").alias("bucket"), F.lit(half).alias("left"))
    rows, out = dealt(rows, 0, level), []
    while True:
        sizes = rows.groupBy("bucket").agg(F.sum(_weight(level, half)).alias("variants"))
        over = sizes.where(F.col("variants") > bucket_variants).select("bucket")
        if level + more >= BITS:
            return [*out, (level, rows)]
        over = staged(over, "full-buckets")
        if not over.take(1):
            return [*out, (level, rows)]
        out.append((level, rows.join(broadcast_if_small(over), "bucket", "left_anti")))
        rows = staged(dealt(rows.join(broadcast_if_small(over), "bucket", "left_semi"), level, more), "dealt-again")
        level += more


def variants(fps: np.ndarray, left: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All variants with at most ``left`` changes in the last ``bits`` bits: their last bits, and whose they are."""
    own = fps & np.uint64((1 << bits) - 1)
    values, owners = [own], [np.arange(len(fps))]
    masks, first = np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    for changes in range(1, int(left.max(initial=0)) + 1):
        grown = [(masks[first <= i] | _BIT[i], i + 1) for i in range(bits)]
        masks, first = (np.concatenate([g[0] for g in grown]), np.concatenate([np.full(len(g[0]), g[1]) for g in grown])) if grown else (
            np.zeros(0, np.uint64), np.zeros(0, np.int64))
        may = np.flatnonzero(left >= changes)
        values.append((own[may, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(may, len(masks)))
    return np.concatenate(values), np.concatenate(owners)


def _collide(bits: int, radius: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The verified collisions of each bucket, what hangs together as a star."""
    for fps, left in sorted_groups(batches, ["bucket"], ["fp", "left"]):
        if len(fps) < 2:
            continue
        nodes = np.array(fps, dtype=np.int64).view(np.uint64)
        values, owners = variants(nodes, np.array(left), bits)
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        same = np.flatnonzero(values[1:] == values[:-1])
        pairs = np.unique(np.stack([owners[same], owners[same + 1]], axis=1), axis=0)  # next to each other in a variant's run
        pairs = pairs[np.bitwise_count(nodes[pairs[:, 0]] ^ nodes[pairs[:, 1]]) <= radius]
        forest = Forest(len(fps))
        for i, j in pairs.tolist():
            forest.join(i, j)
        stars = forest.stars(fps)
        yield pa.record_batch({"a": pa.array([s[0] for s in stars], pa.int64()), "b": pa.array([s[1] for s in stars], pa.int64())})


def links(nodes: DataFrame, radius: int = RADIUS, bucket_variants: int = BUCKET_VARIANTS) -> DataFrame:
    """(a, b): stars of what fingerprints (fp, distinct) within the radius join."""
    out = None
    for level, rows in buckets(nodes, radius, bucket_variants):
        rows = rows.repartition("bucket").sortWithinPartitions("bucket")
        found = rows.mapInArrow(partial(_collide, BITS - level, radius), "a long, b long")
        out = found if out is None else out.union(found)
    return out


def near_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, radius: int = RADIUS,
                      bucket_variants: int = BUCKET_VARIANTS) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest id reachable over links)."""
    if radius % 2 or not 0 <= radius < BITS:
        raise ValueError("the radius is even: its halves meet in the middle")
    rows = staged(fingerprints(docs, id_col, text_col, n), "fingerprints")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")), "fingerprint-nodes")
    found = components(staged(links(nodes, radius, bucket_variants), "fingerprint-links"))
    joined = nodes.join(found, nodes.fp == found.node, "left").withColumn("component", F.coalesce("component", "fp"))
    joined = staged(joined.where("n > 1 or node is not null").select("fp", "component", "least_id"), "fingerprint-components")
    least = joined.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = staged(joined.join(least, "component").select("fp", "component_id", F.lit(True).alias("shared")), "named-fingerprints")
    out = rows.join(broadcast_if_small(named), "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op13_simhash(docs: DataFrame) -> DataFrame:
    out = near_fingerprints(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
