"""Prefix trie of conversations: which turns conversations share from their beginning on, and what that saves.

Distinct turns get dictionary ids, a conversation becomes its ids, and equal conversations become one weighted
sequence, so a group of copies costs one.  The sequences are sorted and cut into range shards of at most
``SHARD_IDS`` ids (or one sequence).  Each shard is a ternary search tree over turn ids, balanced by inserting medians first;
one iterative traversal accumulates members, children, leaves and savings of every node.

A node lies in two shards only if it is a common beginning of one shard's last and the next one's first sequence.
These boundary nodes are merged by plain sums, because every amount is counted in one shard only: a node that the shard before
also holds is its child and its text there, and a node that the next shard goes on from is no leaf.  So shards
never wait for each other, and nothing but boundary nodes is grouped again.

Defined results: turns are ordered by turn (null first), then role, then text; null roles and texts are empty;
repeated rows are repeated turns; rows without a conversation id belong to none and are left out; an empty table
gives an empty result (no root); other columns are ignored.  The ids of one conversation must fit in a row (12 bytes a turn), and
sequences that agree in all of their first ``RANGE_TURNS`` turns are sorted in one task, by spilling.
The digest of a node's conversations runs over its ids in order, block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqcat.llm.common import broadcast_if_small, sorted_groups, staged

SHARD_IDS = 1 << 17  #: turn ids of a shard
MAX_RANGES = 2048  #: range partitions; each is cut into as many shards as it needs
RANGE_TURNS = 64  #: leading turns that the range bounds compare; Spark samples 100 starts a range for them
BLOCK_IDS = 1 << 16  #: conversation ids of a digest block
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
HEAD_SPAN = 100
MOST_HEAD_TURNS = 5


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv_id, pos from 1, key, chars): the turns in order; key is the digest of role and text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select("conv_id", F.row_number().over(in_order).alias("pos"), F.unhex(F.sha2(whole, 256)).alias("key"),
                       F.length("text").alias("chars"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id), and their turns after the first h are taken from the conversation that opens their hundred."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD_TURNS + 1)
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own_turns")).select("conv_id", h.alias("h"))
    heads = turns.where((F.col("conv_id") % HEAD_SPAN == 0) & (F.col("pos") <= MOST_HEAD_TURNS)).withColumnRenamed("conv_id", "head")
    taken = convs.withColumn("head", F.col("conv_id") - F.col("conv_id") % HEAD_SPAN).join(heads, "head").where("pos <= h")
    own = turns.where(F.col("pos") > h)
    return convs.select("conv_id"), own.select("conv_id", "pos", "key", "chars").unionByName(taken.select("conv_id", "pos", "key", "chars"))


def encoded(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, ids, chars, key): every conversation as the dictionary ids and text lengths of its turns."""
    words = staged(turns.select("key").distinct().withColumn("id", F.monotonically_increasing_id()), "turn-dictionary")
    ids = turns.join(words, "key").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "chars"))).alias("t"))
    out = convs.join(ids, "conv_id", "left").select(
        "conv_id", F.coalesce(F.col("t.id"), F.array().cast("array<long>")).alias("ids"),
        F.coalesce(F.col("t.chars"), F.array().cast("array<int>")).alias("chars"))
    return out.withColumn("key", F.unhex(F.sha2(F.array_join("ids", ","), 256)))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, conv_id) -> (key, first, text): the comma-joined ids of a key, at most a block at a time."""
    def rows(key, ids):
        return pa.record_batch({"key": pa.array([key], pa.binary()), "first": pa.array([ids[0]], pa.int64()),
                                "joined": pa.array([",".join(map(str, ids)).encode()], pa.binary())})
    at, ids = None, []
    for b in batches:
        for key, c in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if ids and (key != at or len(ids) >= BLOCK_IDS):
                yield rows(at, ids)
                ids = []
            at = key
            ids.append(c)
    if ids:
        yield rows(at, ids)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (key, first) -> (key, ends): the digest of all ids, one block in memory."""
    at, running, done = None, None, []
    for b in batches:
        for key, joined in zip(b.column("key").to_pylist(), b.column("joined").to_pylist(), strict=True):
            if key != at:
                if running:
                    done.append((at, running.hexdigest()))
                at, running = key, hashlib.sha256(joined)
            else:
                running.update(b",")
                running.update(joined)
        yield pa.record_batch({"key": pa.array([k for k, _ in done], pa.binary()), "ends": pa.array([e for _, e in done], pa.string())})
        done = []
    if running:
        yield pa.record_batch({"key": pa.array([at], pa.binary()), "ends": pa.array([running.hexdigest()], pa.string())})


def end_digests(convs: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ascending ids of each sequence's conversations.  A key of very many is spread over ranges."""
    sorted_ids = convs.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = sorted_ids.mapInArrow(_blocks, "key binary, first long, joined binary")
    return (blocks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends string"))


def sequences(convs: DataFrame) -> DataFrame:
    """Distinct sequences (ids, chars, n, least, ends)."""
    groups = convs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
                                      F.first("ids").alias("ids"), F.first("chars").alias("chars"))
    alone = F.sha2(F.col("least").cast("string").cast("binary"), 256)
    many = staged(groups.where("n > 1").select("key"), "shared-keys")
    ends = end_digests(convs.join(broadcast_if_small(many), "key", "left_semi"))
    return groups.join(ends, "key", "left").select("ids", "chars", "n", "least", F.coalesce("ends", alone).alias("ends"))


def _cut(shard_ids: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the shards of a sorted range: runs of sequences with at most ``shard_ids`` ids and sequences."""
    block = held = 0
    for b in batches:
        numbers = []
        for n in pa.compute.list_value_length(b.column("ids")).to_pylist():
            if held and held + n + 1 > shard_ids:
                block, held = block + 1, 0
            held += n + 1
            numbers.append(block)
        columns = dict(zip(b.schema.names, b.columns, strict=True))
        yield pa.record_batch(columns | {"block": pa.array(numbers, pa.int64())})


def placed(seqs: DataFrame, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Stored sequences (ids, chars, n, least, ends) with the number of their shard; shards ascend as the sequences do."""
    size = seqs.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    ranges = int(min(MAX_RANGES, max(1, size // shard_ids, min(64, size // 4096))))
    rows = seqs.withColumn("start", F.slice("ids", 1, RANGE_TURNS)).repartitionByRange(ranges, "start").drop("start")
    schema = "ids array<bigint>, chars array<int>, n long, least long, ends string, block long"
    rows = rows.sortWithinPartitions("ids").mapInArrow(partial(_cut, shard_ids), schema)
    shard = F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("block")
    return staged(rows.select("ids", "chars", "n", "least", "ends", shard.alias("shard")), "trie-shards")


def _common(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pairs = zip(b.column("upper").to_pylist(), b.column("lower").to_pylist(), strict=True)
        found = []
        for x, y in pairs:
            d = 0
            while d < min(len(x), len(y)) and x[d] == y[d]:
                d += 1
            found.append(d)
        yield pa.record_batch({"before": b.column("before"), "after": b.column("after"), "common": pa.array(found, pa.int64())})


def seams(rows: DataFrame) -> DataFrame:
    """(shard, shared_before, shared_after): turns that its first sequence shares with the shard before, its last with the
    next one; -1 without such a shard.  One row per shard."""
    edges = staged(rows.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last")), "shard-edges")
    order = Window.orderBy("shard")  # one row per shard
    nexts = edges.select("shard").withColumn("after", F.lead("shard").over(order)).where("after is not null")
    pairs = (nexts.join(edges.select("shard", F.col("last").alias("upper")), "shard")
             .join(edges.select(F.col("shard").alias("after"), F.col("first").alias("lower")), "after")
             .select(F.col("shard").alias("before"), "after", "upper", "lower"))
    pairs = staged(pairs.mapInArrow(_common, "before long, after long, common long"), "seams")
    return (edges.select("shard")
            .join(pairs.select(F.col("after").alias("shard"), F.col("common").alias("shared_before")), "shard", "left")
            .join(pairs.select(F.col("before").alias("shard"), F.col("common").alias("shared_after")), "shard", "left")
            .fillna(-1, ["shared_before", "shared_after"]))


class SearchTree:
    """A ternary search tree over turn ids: each node has smaller and larger siblings, and the tree of its next turns.

    Node 0 is the trie's root; ``eq[x]`` is the top of the search tree among the children of node x.
    """

    def __init__(self) -> None:
        self.id, self.lo, self.hi, self.eq = [-1], [-1], [-1], [-1]
        self.up, self.depth, self.chars = [-1], [0], [0]
        self.n, self.least, self.ends = [0], [None], [None]

    def _new(self, turn: int, up: int, chars: int) -> int:
        x = len(self.id)
        for column, value in ((self.id, turn), (self.lo, -1), (self.hi, -1), (self.eq, -1), (self.up, up), (self.depth, self.depth[up] + 1),
                              (self.chars, chars), (self.n, 0), (self.least, None), (self.ends, None)):
            column.append(value)
        return x

    def insert(self, ids: list[int], chars: list[int], n: int, least: int, ends: str) -> None:
        at = 0
        for turn, size in zip(ids, chars, strict=True):
            x = self.eq[at]
            if x < 0:
                x = self.eq[at] = self._new(turn, at, size)
            while (own := self.id[x]) != turn:
                side = self.lo if turn < own else self.hi
                if side[x] < 0:
                    side[x] = self._new(turn, at, size)
                x = side[x]
            at = x
        self.n[at] += n
        self.least[at], self.ends[at] = least, ends

    def in_order(self) -> list[int]:
        """All nodes, a node before its children, siblings by id."""
        out, todo = [], [(0, True)]
        while todo:
            x, whole = todo.pop()
            if whole and self.hi[x] >= 0:
                todo.append((self.hi[x], True))
            if whole:
                todo.append((x, False))
                if self.lo[x] >= 0:
                    todo.append((self.lo[x], True))
            else:
                out.append(x)
                if self.eq[x] >= 0:
                    todo.append((self.eq[x], True))
        return out

    def path(self, ids: list[int], most: int) -> list[int]:
        """The nodes of the first ``most`` turns of an inserted sequence, the root first."""
        out, x = [0], self.eq[0]
        for turn in ids[:most]:
            while self.id[x] != turn:
                x = self.lo[x] if turn < self.id[x] else self.hi[x]
            out.append(x)
            x = self.eq[x]
        return out


def balanced(n: int) -> Iterator[int]:
    """0..n-1, medians first."""
    todo = [(0, n)]
    while todo:
        a, z = todo.pop()
        if a < z:
            mid = (a + z) // 2
            yield mid
            todo += [(mid + 1, z), (a, mid)]


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
        "node binary, parent binary")


def shard_nodes(seqs: list[tuple], shared_before: int, shared_after: int) -> Iterator[tuple]:
    """The nodes of one shard from its sorted sequences (ids, chars, n, least, ends), as in ``NODE``.  ``node`` is the
    digest of a boundary node, ``parent`` that of a node whose parent is one."""
    tree = SearchTree()
    for i in balanced(len(seqs)):
        tree.insert(*seqs[i])
    shared = tree.path(seqs[0][0], shared_before) if shared_before >= 0 else []  # also in the shard before
    going_on = tree.path(seqs[-1][0], shared_after) if shared_after >= 0 else []  # also in the next shard
    digest: dict[int, bytes] = {}
    for path, ids in ((shared, seqs[0][0]), (going_on, seqs[-1][0])):
        running = hashlib.sha256()
        for d, x in enumerate(path):
            if d:
                running.update(b"%d," % ids[d - 1])
            digest[x] = running.digest()
    again, going_on = set(shared), set(going_on)
    size, up = len(tree.id), tree.up
    members, least = list(tree.n), list(tree.least)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    order = tree.in_order()
    for x in reversed(order):  # children before their parents
        saved[x] += members[x] * tree.chars[x] - (0 if x in again else tree.chars[x])
        if tree.eq[x] < 0 and x not in going_on:
            leaves[x] = 1
        if (p := up[x]) >= 0:
            members[p] += members[x]
            if least[p] is None or least[x] < least[p]:
                least[p] = least[x]
            children[p] += x not in again
            leaves[p] += leaves[x]
            saved[p] += saved[x]
    for x in order:
        p = up[x]
        across = digest.get(p)
        yield (least[x], tree.depth[x], None if p < 0 or across is not None else least[p], members[x], children[x], leaves[x], saved[x],
               tree.ends[x], digest.get(x), across)


def _nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and sequence -> nodes; one shard in memory."""
    names = [c.split()[0] for c in NODE.split(", ")]
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    kinds = [types[c.split()[1]] for c in NODE.split(", ")]
    columns = ["ids", "chars", "n", "least", "ends", "shared_before", "shared_after"]
    for ids, chars, n, least, ends, before, after in sorted_groups(batches, ["shard"], columns):
        found = list(shard_nodes(list(zip(ids, chars, n, least, ends, strict=True)), before[0], after[0]))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)


def trie(convs: DataFrame, shard_ids: int = SHARD_IDS) -> DataFrame:
    """One row per trie node of encoded conversations (conv_id, ids, chars, key): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = staged(convs, "encoded-conversations")
    rows = placed(staged(sequences(convs), "sequences"), shard_ids)
    full = rows.join(broadcast_if_small(staged(seams(rows), "shard-seams")), "shard")
    nodes = staged(full.repartition("shard").sortWithinPartitions("shard", "ids").mapInArrow(_nodes, NODE), "trie-nodes")
    shared = nodes.where("node is not null").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends").alias("ends"), F.first("parent").alias("parent"))
    shared = staged(shared, "boundary-nodes")
    parents = broadcast_if_small(staged(shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("across")), "boundary-ids"))
    inner = nodes.where("node is null")
    done = inner.where("parent is null").select(*OUT)
    below = inner.where("parent is not null").drop("parent_conv_id", "node").unionByName(shared.drop("node"))
    below = below.join(parents, "parent", "left").withColumnRenamed("across", "parent_conv_id")
    return done.unionByName(below.select(*OUT)).select(*OUT[:-1], F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))


OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")


def prefix_trie(conversations: DataFrame, shard_ids: int = SHARD_IDS) -> DataFrame:
    """The trie of the conversations as they stand."""
    turns = staged(numbered_turns(conversations), "turns")
    return trie(encoded(turns.select("conv_id").distinct(), turns), shard_ids)


def op11_prefix_trie(conversations: DataFrame, shard_ids: int = SHARD_IDS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns = staged(numbered_turns(conversations), "turns")
    return trie(encoded(*rebuilt(turns)), shard_ids)


ORACLE = r"""
WITH RECURSIVE crc(c, s, i, v) AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, s, i + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(s[i // 8 + 1:i // 8 + 1])::BIGINT) ELSE v END AS x FROM crc WHERE i < 8 * length(s))),
convs AS (SELECT c, xor(v, 4294967295) % 6 AS h FROM crc WHERE i = 8 * length(s)),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
built AS (
  SELECT convs.c, pos, role, text FROM convs JOIN turns ON turns.c = convs.c - convs.c % 100 AND pos <= h
  UNION ALL SELECT c, pos, role, text FROM convs JOIN turns USING (c) WHERE pos > h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS depth, sha256(length(role) || ':' || role || text) AS turn,
                  length(text) AS chars FROM built),
paths AS (
  SELECT c, 0 AS depth, '' AS path, 0 AS chars FROM convs
  UNION ALL SELECT c, depth, md5(string_agg(turn, ',') OVER (PARTITION BY c ORDER BY depth)) AS path, chars FROM placed),
ups AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY depth) AS up, lead(path) OVER (PARTITION BY c ORDER BY depth) IS NULL AS is_end FROM paths),
nodes AS (
  SELECT path, min(c) AS conv_id, any_value(depth)::BIGINT AS depth, any_value(up) AS up, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
  FROM ups GROUP BY path),
kids AS (SELECT up, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * chars AS saved FROM nodes LEFT JOIN kids ON kids.up = nodes.path),
below AS (  -- every node counts for all nodes above it: those on its smallest member's way
  SELECT paths.path, sum(own.saved)::BIGINT AS saved_tokens, count(*) FILTER (own.n_children = 0) AS n_leaves
  FROM own JOIN paths ON paths.c = own.conv_id AND paths.depth <= own.depth GROUP BY paths.path)
SELECT own.conv_id, own.depth, p.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens, own.ends_sha256
FROM own JOIN below USING (path) LEFT JOIN nodes p ON p.path = own.up
"""
