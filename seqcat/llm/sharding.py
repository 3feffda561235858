"""Sharding by fixed virtual slots.

Every record hashes to one of ``n_slots`` virtual slots, for ever.  A small versioned table says which
shard holds each slot.  Rebalancing never rehashes records: it counts the bytes of each slot and writes a
new version of the table in which only some slots have moved.  All of it is DataFrame expressions; the
slot table has ``n_slots`` rows whatever the data holds, so it may be broadcast and folded in one row.

Defined results: a null text has no bytes (checksum of the empty text); a null id is hashed by its text;
repeated rows share a virtual slot and get positions of their own; an empty table gives an empty result;
extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqcat.llm.common import staged
from seqcat.session import scratch_dir

N_SLOTS = 4096
ROW_BYTES = 8  #: counted for every row besides its text


def virtual_slot(id_col: Column, text_col: Column, n_slots: int = N_SLOTS) -> Column:
    """The record's slot: its hash, so it never changes while the record does not."""
    return F.pmod(F.xxhash64(id_col, text_col), F.lit(n_slots)).cast("int")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """Narrow rows (id, size, text_crc32, vslot): all that sharding needs of a record."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       virtual_slot(F.col(id_col), F.col(text_col), n_slots).alias("vslot"))


def slot_sizes(rows: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(vslot, n_rows, bytes) of every slot, empty ones too."""
    seen = rows.groupBy("vslot").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("bytes"))
    slots = rows.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("vslot"))
    return slots.join(F.broadcast(seen), "vslot", "left").fillna(0, ["n_rows", "bytes"])


def first_map(spark: SparkSession, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Version 1 of the slot table (vslot, shard): slots dealt out in turn, sizes unknown."""
    return spark.range(n_slots).select(F.col("id").cast("int").alias("vslot"),
                                       (F.col("id") % n_shards).cast("int").alias("shard"))


def rebalanced(slot_map: DataFrame, sizes: DataFrame, n_shards: int) -> DataFrame:
    """The edited map: each shard keeps its largest slots up to the mean size; the others, and the slots of
    shards that are gone, go one by one, largest first, to the shard with the least bytes."""
    by_size = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    whole = Window.partitionBy(F.lit(0))
    known = slot_map.join(sizes, "vslot").select("vslot", "shard", "bytes")
    known = known.withColumn("stays", (F.col("shard") < n_shards) & (
        F.sum("bytes").over(by_size) * n_shards <= F.sum("bytes").over(whole)))
    slot = F.struct("bytes", "vslot", "shard")
    folded = known.agg(F.collect_list(F.when(F.col("stays"), slot)).alias("kept"),
                       F.sort_array(F.collect_list(F.when(~F.col("stays"), slot)), asc=False).alias("moved"))
    folded = folded.withColumn("loads", F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda s: F.aggregate("kept", F.lit(0).cast("long"),
                              lambda acc, k: acc + F.when(k["shard"] == s, k["bytes"]).otherwise(0))))

    def place(acc, m):
        least = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        return F.struct(
            F.transform(acc["loads"], lambda v, i: v + F.when(i == least, m["bytes"]).otherwise(0)).alias("loads"),
            F.array_append(acc["placed"], F.struct(m["bytes"].alias("bytes"), m["vslot"].alias("vslot"),
                                                   least.alias("shard"))).alias("placed"))

    start = F.struct(F.col("loads").alias("loads"),
                     F.array().cast("array<struct<bytes:bigint,vslot:int,shard:int>>").alias("placed"))
    placed = F.aggregate("moved", start, place)["placed"]
    return folded.select(F.inline(F.concat("kept", placed))).select("vslot", "shard")


def save_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Store one version of the slot table; older versions stay readable."""
    slot_map.coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """One version of the slot table."""
    return spark.read.schema("vslot int, shard int").parquet(f"{path}/version={version}")


def assigned(rows: DataFrame, sizes: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Rows with ``shard`` and ``slot``: the row's place in its shard, gapless from 0.

    Places are the slot's start in its shard (a running sum over the slot table) plus the row's rank in
    its virtual slot, so no task sorts a shard; ties by id, checksum and size are identical rows.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(sizes, "vslot").select(
        "vslot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("start"))
    first = rows.columns[0]
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy(first, "text_crc32", "size"))
    ranked = rows.withColumn("rank", rank - 1)
    return ranked.join(F.broadcast(starts), "vslot").select(
        *rows.columns, "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot"))


def balanced_map(rows: DataFrame, n_shards: int, n_slots: int = N_SLOTS, map_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(slot table, slot sizes) for sized rows: versions 1 (as dealt) and 2 (rebalanced) are stored under
    ``map_path``, a fresh scratch folder by default."""
    spark = rows.sparkSession
    path = map_path or scratch_dir(spark, "slot-map")
    sizes = staged(slot_sizes(rows, n_slots).coalesce(1), "slot-sizes")
    save_map(first_map(spark, n_shards, n_slots), path, 1)
    save_map(rebalanced(load_map(spark, path, 1), sizes, n_shards), path, 2)
    return load_map(spark, path, 2), sizes


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                    n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Assign every row to a shard so that the shards' bytes are near equal: narrow rows with their places."""
    rows = staged(sized(docs, id_col, text_col, n_slots), "sized")
    slot_map, sizes = balanced_map(rows, n_shards, n_slots, map_path)
    return assigned(rows, sizes, slot_map)


def with_shards(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """All columns and ``vslot`` and ``shard`` (replacing columns of that name); texts aren't shuffled."""
    slot_map, _ = balanced_map(staged(sized(docs, n_slots=n_slots), "sized"), n_shards, n_slots)
    out = docs.drop("vslot", "shard").withColumn("vslot", virtual_slot(F.col("doc_id"), F.col("text"), n_slots))
    return out.join(F.broadcast(slot_map), "vslot").select(*docs.drop("vslot", "shard").columns, "vslot", "shard")


def op1_sharding(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns over 24 shards; the law is ``bytes``, so ``grown_shard`` is null."""
    out = shard_documents(docs, 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "vslot")
