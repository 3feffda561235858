"""Near-duplicate documents: MinHash signatures in a signature-coordinate inverted join.

A node is a distinct set of word shingles; documents with equal sets share one, so groups of copies cost
one node.  Every node is posted under its (coordinate, value) pairs.  A pair of nodes is a candidate when at
least ``matches(percent)`` of ``COORDINATES`` values collide:

* skip: values held by one node alone can't collide; nodes with fewer other values have no
  candidates at all;
* prefix: of its ``s`` values that collide, a node is posted under the ``s - matches + 1`` rarest only; by the
  prefix-filter principle any candidate pair meets there;
* merge: a posting list counts collisions between its members' whole signatures in blocks, and hands on
  what hangs together by candidate pairs as a star around its smallest node, never all pairs.

Candidate pairs that hang together form a cluster.  A cluster's full shingle sets meet once; every candidate
pair whose ends are not linked yet is confirmed by its exact Jaccard similarity, and what the confirmed
links join is handed on as a star again.  Long lists and clusters of many nodes or bytes are dealt out as pairs of blocks,
so no task holds more than two blocks.  The components of the confirmed links are those of all links.

With similarity 0.85 a pair has Binomial(32, 0.85) collisions: fewer than 18 with probability below 2e-5.  Other
similarities take the largest number of collisions for which that holds.

``one_of_each`` keeps one row of each group: the smallest id's, of equal ids (or where all are null) the one of the
smallest hash of its id and text, of rows equal in both one.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text with fewer than five words
is one shingle; null and empty texts have none, are linked with nothing and are their own component; null
ids count as larger than all others (a component of null ids only has a null id); repeated rows are copies;
an empty table gives an empty result; extra columns are ignored.  ``one_of_each`` keeps every row without words (it is in
no group) and all columns as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqcat.llm.common import broadcast_if_small, slices, sorted_groups, space_words, staged
from seqcat.llm.graph import Forest, components

SHINGLE = 5
PERCENT = 85
COORDINATES = 32
MISSED = 2e-5  #: probability that a pair of the least similarity has too few collisions
LIST_BLOCK = 2048  #: nodes of a posting list in a block
SET_BLOCK = 16 << 20  #: bytes of shingle sets of a cluster in a block
CLUSTER_BLOCK = 1024  #: nodes of a cluster in a block
WORD_CACHE = 1 << 19

_FACTORS = (np.random.default_rng(20240607).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def matches(percent: int) -> int:
    """The largest number of collisions that pairs of similarity ``percent`` miss with probability below ``MISSED``."""
    p, below = percent / 100, 0.0
    for k in range(COORDINATES):
        below += math.comb(COORDINATES, k) * p ** k * (1 - p) ** (COORDINATES - k)
        if below >= MISSED:
            return max(k, 1)
    return COORDINATES


class WordHashes:
    """64-bit hashes of words, cached up to a fixed number."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hashes of the n-word shingles in order; fewer words are one shingle."""
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1 if n else 0, dtype=np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(out)]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def signature(sets: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(sets), 4096):
        v = sets[i:i + 4096, None] * _FACTORS[None, :]
        v ^= v >> np.uint64(31)
        least = np.minimum(least, v.min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = WordHashes()
    for b in slices(batches):
        sizes, keys, sigs = [], [], []
        for text in b.column("text").to_pylist():
            s = np.unique(shingles(hashed(space_words(text))))
            sizes.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sigs.append(signature(s).tobytes() if len(s) else None)
        yield pa.record_batch({"doc_id": b.column("doc_id"), "rid": b.column("rid"), "n_shingles": pa.array(sizes, pa.int64()),
                               "node": pa.array(keys, pa.binary()), "sig": pa.array(sigs, pa.binary())})


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = WordHashes()
    for b in slices(batches):
        sets = [np.unique(shingles(hashed(space_words(t)))).tobytes() for t in b.column("text").to_pylist()]
        yield pa.record_batch({"doc_id": b.column("doc_id"), "rid": b.column("rid"), "shingles": pa.array(sets, pa.binary())})


def _values(sig: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"v": [np.frombuffer(x, dtype=np.uint32).astype(np.int64) for x in sig]})


def block_pairs(df: DataFrame, n_blocks: Column, by: Column) -> DataFrame:
    """Deal the rows of a group out as pairs of blocks (lo, hi): rows of any two blocks meet in one pair."""
    own = F.pmod(F.xxhash64(by), n_blocks)
    df = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks.cast("long") - 1)))
    return df.withColumn("lo", F.least("_own", "_other")).withColumn("hi", F.greatest("_own", "_other")).drop("_own", "_other")


def _pairs(found: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch({c: pa.array([f[i] for f in found], pa.binary()) for i, c in enumerate("ab")})


def _candidates(least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidate pairs of each posting list (or pair of its blocks), each hanging-together set as a star."""
    found = []
    for nodes, sigs in sorted_groups(batches, ["post", "lo", "hi"], ["node", "sig"]):
        sig = np.frombuffer(b"".join(sigs), dtype=np.uint32).reshape(len(nodes), -1)
        forest = Forest(len(nodes))
        for i in range(len(nodes) - 1):
            hits = np.flatnonzero((sig[i + 1:] == sig[i]).sum(axis=1) >= least) + i + 1
            for j in hits.tolist():
                forest.join(i, j)
        found += forest.stars(nodes)
        if len(found) > 10_000:
            yield _pairs(found)
            found = []
    yield _pairs(found)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, of sorted distinct arrays."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirm(percent: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The confirmed links of each cluster (or pair of its blocks), each hanging-together set as a star."""
    fewest = matches(percent)
    for nodes, sigs, blobs in sorted_groups(batches, ["cluster", "lo", "hi"], ["node", "sig", "shingles"]):
        sig = np.frombuffer(b"".join(sigs), dtype=np.uint32).reshape(len(nodes), -1)
        sets = [np.frombuffer(x, dtype=np.uint64) for x in blobs]
        forest = Forest(len(nodes))
        # pairs with many collisions first: they are likely links, and linked ends need no further proof
        for least, most in ((28, COORDINATES), (24, 27), (fewest, 23)):
            for i in range(len(nodes) - 1):
                same = (sig[i + 1:] == sig[i]).sum(axis=1)
                for j in (np.flatnonzero((same >= least) & (same <= most)) + i + 1).tolist():
                    if forest.root(i) != forest.root(j) and similar(sets[i], sets[j], percent):
                        forest.join(i, j)
        yield _pairs(forest.stars(nodes))


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored narrow rows (doc_id, rid, n_shingles, node, sig)."""
    return staged(_texts(docs, id_col, text_col).mapInArrow(
        _sketch, "doc_id long, rid long, n_shingles long, node binary, sig binary"), "sketches")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(id_col, text_col).alias("rid"),
                       F.col(text_col).alias("text"))


def candidate_pairs(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): stars of what candidate pairs of nodes (node, sig) join."""
    least = matches(percent)
    values = F.pandas_udf(_values, "v array<long>")
    posts = nodes.select("node", "sig", F.posexplode(values("sig")["v"]).alias("c", "v"))
    posts = posts.select("node", (F.col("c") * F.lit(1 << 32) + F.col("v")).alias("post"))
    common = posts.groupBy("post").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = posts.join(common, "post").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "post"))).alias("posts"))  # COORDINATES at most
    lists = lists.where(F.size("posts") >= least).select(
        "node", F.explode(F.slice("posts", F.lit(1), F.size("posts") - least + 1)).alias("p"))
    lists = lists.select("node", "p.post", "p.df").join(nodes, "node")
    lists = block_pairs(lists, F.ceil(F.col("df") / LIST_BLOCK), F.col("node"))
    return (lists.repartition("post", "lo", "hi").sortWithinPartitions("post", "lo", "hi")
            .mapInArrow(partial(_candidates, least), "a binary, b binary"))


def confirmed_links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """(a, b): stars of what links that full sets confirm join."""
    clusters = components(pairs).withColumnRenamed("component", "cluster")
    members = staged(nodes.join(clusters, "node"), "cluster-members")
    sizes = members.groupBy("cluster").agg(F.sum(8 * F.col("n_shingles") + 200).alias("set_bytes"), F.count(F.lit(1)).alias("n_nodes"))
    wanted = broadcast_if_small(members.select(F.col("doc_id").alias("id"), F.col("rid").alias("r")))
    texts = _texts(docs, id_col, text_col).join(wanted, (F.col("rid") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = texts.dropDuplicates(["rid", "doc_id"]).mapInArrow(_sets, "doc_id long, rid long, shingles binary").select(
        F.col("doc_id").alias("id"), F.col("rid").alias("r"), "shingles")
    full = members.join(sets, (F.col("rid") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("id"))).join(sizes, "cluster")
    full = full.select("cluster", "node", "sig", "shingles", "set_bytes", "n_nodes")
    n_blocks = F.ceil(F.greatest(F.col("set_bytes") / SET_BLOCK, F.col("n_nodes") / CLUSTER_BLOCK))
    full = block_pairs(full, n_blocks, F.col("node"))
    return (full.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")
            .mapInArrow(partial(_confirm, percent), "a binary, b binary"))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, rid (hash of id and text), n_shingles, component (null without words), component_id, kept."""
    rows = sketched(docs, id_col, text_col)
    nodes = staged(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("rid", "doc_id")).alias("one"), F.first("sig").alias("sig"),
        F.first("n_shingles").alias("n_shingles")).select("node", "least_id", "one.rid", "one.doc_id", "sig", "n_shingles"), "nodes")
    pairs = staged(candidate_pairs(nodes.select("node", "sig"), percent), "candidates")
    links = confirmed_links(docs, nodes, pairs, id_col, text_col, percent)
    found = components(links)
    nodes = nodes.select("node", "least_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    nodes = staged(nodes, "node-components")
    least = nodes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = nodes.join(least, "component").select("node", "component", "component_id")
    out = rows.select("doc_id", "rid", "n_shingles", "node").join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "rid", "n_shingles", "component", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    return grouped(docs, id_col, text_col, percent).drop("rid", "component")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group and every row without words, unchanged."""
    rows = staged(grouped(docs, percent=percent).where("component is not null").groupBy("component", "doc_id", "rid").agg(
        F.count(F.lit(1)).alias("copies")), "grouped")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    first = rows.groupBy("component").agg(F.min(place).alias("first"))
    rows = rows.join(first, "component").select("doc_id", "rid", "copies", (place == F.col("first")).alias("stays"))
    marked = staged(rows.where("not stays or copies > 1").select("doc_id", "rid", "stays"), "marked")

    def among(right: DataFrame, how: str) -> DataFrame:
        right = broadcast_if_small(right)
        same = (F.xxhash64(docs["doc_id"], docs["text"]) == right["rid"]) & docs["doc_id"].cast("long").eqNullSafe(right["doc_id"])
        return docs.join(right, same, how)

    once = among(marked, "left_anti")
    repeated = marked.where("stays")
    if repeated.isEmpty():
        return once
    again = among(repeated, "left_semi").select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("rid"))
    order = Window.partitionBy("rid", "row.doc_id").orderBy(F.xxhash64(F.to_json("row")))
    return once.union(again.withColumn("place", F.row_number().over(order)).where("place = 1").select("row.*"))


def op9_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


ORACLE = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingled AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {SHINGLE} THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(ws) - {SHINGLE - 2})] END)) AS shingles FROM worded),
named AS (SELECT doc_id, len(shingles) AS n, CASE WHEN len(shingles) > 0 THEN md5(array_to_string(shingles, chr(10))) END AS node, shingles FROM shingled),
nodes AS (SELECT node, min(doc_id) AS least_id, any_value(n) AS n, any_value(shingles) AS shingles FROM named WHERE node IS NOT NULL GROUP BY node),
entries AS (SELECT node, n, unnest(shingles) AS shingle FROM nodes),
links AS (
  SELECT a.node AS a, b.node AS b FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.node <> b.node
  WHERE 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reached AS (SELECT node, node AS other FROM nodes UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other),
joined AS (SELECT r.node, min(o.least_id) AS component_id FROM reached r JOIN nodes o ON o.node = r.other GROUP BY r.node)
SELECT d.doc_id, d.n AS n_shingles, CASE WHEN d.node IS NULL THEN d.doc_id ELSE j.component_id END AS component_id,
  d.doc_id IS NOT DISTINCT FROM CASE WHEN d.node IS NULL THEN d.doc_id ELSE j.component_id END AS kept
FROM named d LEFT JOIN joined j ON d.node = j.node
"""
