"""Benchmark decontamination with a broadcast set of benchmark n-grams.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is 13
consecutive words of a benchmark item; an item with fewer words is one window.  Each document is scanned
once: rolling hashes of its windows are looked up in the broadcast hash set, and every hit is verified word
by word.  Words inside a verified window are hit.

Only a block of the benchmark of at most ``block_bytes`` of text is collected and broadcast at a time; its
size is measured first, and exact running sums of bytes cut the blocks.  A larger benchmark is scanned block by block, with the hits of earlier blocks carried
along in a stored table, so neither driver nor executors ever hold more than one block (one item
longer than a block is a block).

Defined results: null and empty texts have no words, are never hit and hit nothing; items without words are
ignored; a null item id is left out of the item list but its windows hit; repeated items or rows are treated
alike; empty tables give no hits or no rows.  Extra columns of the documents are kept; the new columns
``report`` and ``clean_text`` replace columns of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqcat.llm.common import aside, staged, table

WINDOW = 13
BLOCK_BYTES = 16 << 20
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_TO_WORDS = bytes(ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256))
REPORT = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>, cuts array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


class GramSet:
    """Windows of benchmark items, found by hash and verified by their words."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW) -> None:
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if n := min(len(ids), window):
                grams = by_length.setdefault(n, {})
                for i in range(len(ids) - n + 1):
                    grams.setdefault(tuple(ids[i:i + n]), set()).update([item] if item is not None else [])
        self.sets = []
        for n, grams in sorted(by_length.items()):
            ids = np.array(list(grams), dtype=np.uint64).reshape(len(grams), n)
            hashes = self._hash(ids.reshape(-1), np.arange(len(grams)) * n, n)
            order = np.argsort(hashes, kind="stable")
            lists = list(grams.values())
            self.sets.append((n, hashes[order], ids[order], [lists[i] for i in order]))

    @staticmethod
    def _hash(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        h = np.zeros(len(starts), dtype=np.uint64)
        for k in range(n):
            h = h * _PRIME + ids[starts + k]
        return h

    def scan(self, ws: list[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        """Items with a window in the words, and the merged (start, end) word ranges that are hit."""
        known = self.vocabulary.get
        ids = np.array([known(w, 0) for w in ws], dtype=np.uint64)
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        items: set[str] = set()
        hits: list[tuple[int, int]] = []
        for n, hashes, grams, lists in self.sets:
            if len(ids) < n:
                continue
            starts = np.flatnonzero(unknown[n:] == unknown[:-n])  # windows of known words only
            if not len(starts):
                continue
            found = self._hash(ids, starts, n)
            left, right = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            for k in np.flatnonzero(right > left):
                i = int(starts[k])
                for j in range(left[k], right[k]):
                    if (grams[j] == ids[i:i + n]).all():
                        items |= lists[j]
                        hits.append((i, i + n))
        merged: list[tuple[int, int]] = []
        for a, b in sorted(hits):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return items, merged


def _byte_ranges(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """UTF-8 byte ranges of word ranges: 1:1 with the translated text."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.encode("utf-8", "surrogatepass").translate(_TO_WORDS))]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


def report(text: Column, grams) -> Column:
    """A struct per text: n_words, n_hit, items, spans (word ranges) and cuts (byte ranges).  ``grams`` is a
    broadcast list of (item, text)."""
    @F.pandas_udf(REPORT)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = GramSet(grams.value)
        for batch in texts:
            out = []
            for t in batch:
                ws = words(t)
                items, spans = known.scan(ws) if ws else (set(), [])
                pairs = [{"start": a, "end": b} for a, b in spans]
                cuts = [{"start": a, "end": b} for a, b in _byte_ranges(t, spans)] if spans else []
                out.append((len(ws), sum(b - a for a, b in spans), sorted(items), pairs, cuts))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans", "cuts"])
    return scan(text)


def _joined(spans: Column) -> Column:
    """Merge sorted overlapping ranges."""
    kind = "array<struct<start:int,end:int>>"
    return F.aggregate(F.array_sort(spans), F.array().cast(kind), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["start"].alias("start"),
            F.greatest(F.try_element_at(acc, F.lit(-1))["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))


def _bytes(items: DataFrame) -> int:
    return items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def in_blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Distinct (item, text) with ``block``, and the number of blocks: none holds more than ``block_bytes`` of text, but
    for a single longer item.

    Items are dealt by hash to groups of about a quarter of a block.  Exact running sums cut a group into pieces: an
    item of over half a block is a piece, and so are the others that begin within the same half block.  Pieces
    are packed in order; only their sizes, a few numbers a block, come to the driver.
    """
    size = F.octet_length("text").cast("long")
    items = items.distinct().where(size > 0).withColumn("size", size)
    n_groups, half = max(1, -(-4 * _bytes(items) // block_bytes)), max(1, block_bytes // 2)
    group = Window.partitionBy("group").orderBy("item", "text")
    before = F.coalesce(F.sum("size").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = staged(items.withColumn("group", F.pmod(F.xxhash64("item", "text"), F.lit(n_groups))).withColumn(
        "piece", F.when(F.col("size") > half, -F.row_number().over(group)).otherwise(F.floor(before / half)).cast("long")), "benchmark-pieces")
    packed, block, room = [], -1, 0
    for r in pieces.groupBy("group", "piece").agg(F.sum("size").alias("size")).orderBy("group", "piece").collect():
        if block < 0 or r["size"] > room:
            block, room = block + 1, block_bytes
        room -= r["size"]
        packed.append((r["group"], r["piece"], block))
    packed = items.sparkSession.createDataFrame(packed, "group long, piece long, block int")
    return staged(pieces.join(F.broadcast(packed), ["group", "piece"]).select("item", "text", "block"), "benchmark-blocks"), block + 1


def scanned(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``report``."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text"))
    total, n_blocks = _bytes(items), 1
    if total > block_bytes:
        items, n_blocks = in_blocks(items, block_bytes)
    out = docs.drop("report")
    for k in range(n_blocks):
        block = items.where(F.col("block") == k).drop("block") if n_blocks > 1 else items.select("item", "text")
        grams = spark.sparkContext.broadcast([tuple(r) for r in block.collect()])  # at most a block of bytes, or one item
        if n_blocks == 1:
            return out.withColumn("report", report(F.col(text_col), grams))
        new = out.withColumn("_new", report(F.col(text_col), grams))
        if k:
            spans = _joined(F.concat("report.spans", "_new.spans"))
            new = new.withColumn("_new", F.struct(
                F.col("_new.n_words").alias("n_words"),
                F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
                F.array_sort(F.array_union("report.items", "_new.items")).alias("items"), spans.alias("spans"),
                _joined(F.concat("report.cuts", "_new.cuts")).alias("cuts")))
        out = staged(new.drop("report").withColumnRenamed("_new", "report"), "decontaminate")
    return out


def contaminated(share: int = 20) -> Column:
    return (F.col("report.n_hit") > 0) & (F.col("report.n_hit") * share >= F.col("report.n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Drop contaminated documents; all others stay as they are."""
    docs, columns = aside(docs, "report", "_new")
    return scanned(docs, benchmark, text_col).where(~contaminated()).select(*columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """All documents, with ``clean_text``: the text without the hit spans (first to last byte of their words)."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        def one(t, ranges):
            if t is None or not len(ranges):
                return t
            raw, parts, at = t.encode("utf-8", "surrogatepass"), [], 0
            for r in ranges:
                parts.append(raw[at:r["start"]])
                at = r["end"]
            return b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass")
        return pd.Series([one(t, r) for t, r in zip(texts, cuts, strict=True)], dtype=object)
    return scanned(docs, benchmark, text_col).withColumn("clean_text", cut(F.col(text_col), F.col("report.cuts"))).drop("report")


def op5_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = scanned(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.col("report.n_words").alias("n_words"), F.col("report.n_hit").alias("n_hit"),
                      F.size("report.items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("report.items", ","), 256).alias("items_sha256"),
                      contaminated().alias("contaminated"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
b AS (SELECT DISTINCT item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS gram
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM (SELECT *, least(len(w), 13) AS n FROM bw WHERE len(w) > 0))),
d AS (SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS gram
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM dw, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM d JOIN b USING (n, gram)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
