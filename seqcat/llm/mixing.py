"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a token target.  Complete epochs come first: every row is taken ``floor(target / size of the
source)`` times.  The rest of the target is a weighted sample without replacement: row keys
``-ln(u) / weight`` ascending, prefix-summed to the remaining budget; the row that crosses it is taken if the
budget reaches its middle.  ``u`` is a hash of the record, so reruns agree.

A source is never sorted in one task.  Keys fall into ``n_blocks`` ordered blocks per source; block totals
give each block's start, and only rows within a (source, block) group are sorted.  All of it is DataFrame
expressions.

Defined results: a null or empty text has no words and is never taken; a null source is a source of its
own, last in order; null or missing quality weighs 1; repeated rows draw the same key and are taken one
after the other; an empty table gives an empty result; extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqcat.llm.common import aside, broadcast_if_small, staged, table

WORD = r"[^\x20\x09-\x0D]+"
SHARE = 1.5  #: of all sizes, given out over the sources
MOST_EPOCHS = 2  #: a target never exceeds so many times its source's size
WEIGHTS = (3, 1, 2)  #: of the sources in order, repeating
N_BLOCKS = 1024
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}  #: sampling weight by label; rows without one weigh 1


def source_key(source: Column) -> Column:
    """Text that is never null and sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the record alone."""
    bits = F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1))
    return (bits.cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST_EPOCHS,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(skey, source_size) -> the same with ``target``.

    Capped shares are the fixed point of min(most * size, rate * weight) = share * all sizes; with sources
    in order of size / weight, the capped ones come first and the rate follows from running sums.  One row
    per source.
    """
    order = Window.orderBy("skey")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1)
    s = sizes.withColumn("n", F.row_number().over(order)).withColumn("w", w)
    s = s.withColumn("cap", F.col("source_size") * float(most))
    by = Window.orderBy(F.col("cap") / F.col("w"), "skey")
    before, onward = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(all_rows) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    s = s.withColumn("rate", left / F.sum("w").over(onward))
    s = s.withColumn("capped", F.col("rate") * F.col("w") >= F.col("cap"))
    s = s.withColumn("rate", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), "skey", "rate")))
                     .over(all_rows)["rate"])
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("rate") * F.col("w"))
    return s.select("skey", "source_size", target.alias("target"))


def mix(rows: DataFrame, n_blocks: int = N_BLOCKS, **shares) -> DataFrame:
    """Rows (id, skey, size, weight, u) -> the same with ``key``, ``source_size``, ``target``, ``epochs`` (complete
    ones), ``more`` (one copy more) and ``taken`` (words taken, repeats counted)."""
    # the block number is a monotone function of the key: uniform for weight 1
    keyed = rows.withColumn("key", -F.log("u") / F.col("weight"))
    keyed = keyed.withColumn("block", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * n_blocks).cast("int"))
    blocks = staged(keyed.groupBy("skey", "block").agg(F.sum("size").alias("block_size")), "mix-blocks")
    goals = staged(targets(blocks.groupBy("skey").agg(F.sum("block_size").alias("source_size")), **shares),
                   "mix-targets")
    within = Window.partitionBy("skey").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("block_size").over(within), F.lit(0))).drop("block_size")
    starts = starts.join(goals, "skey")
    first = rows.columns[0]
    run = Window.partitionBy("skey", "block").orderBy("key", first, "size").rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.withColumn("run", F.coalesce(F.sum("size").over(run), F.lit(0))).join(starts, ["skey", "block"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.col("target") - epochs * F.col("source_size")
    more = (F.col("start") + F.col("run") + F.col("size") / 2 <= budget) & (budget > 0)
    out = out.select(*rows.columns, "key", "source_size", "target", epochs.cast("int").alias("epochs"), more.alias("more"))
    return out.withColumn("taken", (F.col("epochs") + F.col("more").cast("int")) * F.col("size"))


def quality(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) from quality labels; of several labels of a document the largest counts."""
    w = F.coalesce(*[F.when(F.col("q") == k, F.lit(v)) for k, v in QUALITY_WEIGHTS.items()], F.lit(1.0))
    best = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return best.select("doc_id", w.alias("weight"))


def measured(docs: DataFrame, labels: DataFrame, seed: int = 1) -> DataFrame:
    """Narrow rows (doc_id, skey, size, weight, u) of all documents, stored once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", source_key(F.col("source")).alias("skey"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       uniform(F.col("doc_id"), F.col("text"), F.lit(seed)).alias("u"))
    return staged(rows.join(quality(labels), "doc_id", "left").fillna(1.0, ["weight"])
                  .select("doc_id", "skey", "size", "weight", "u"), "mix-rows")


def mixed_documents(docs: DataFrame, labels: DataFrame, seed: int = 1) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged.

    A row's share follows from its own key and its source's epochs and largest key taken, so texts are joined
    with narrow tables only; rows with that very key (repeats) are all taken.
    """
    docs, columns = aside(docs, "_id", "_weight", "skey", "_epochs", "_cut", "_copy")
    out = mix(measured(docs, labels, seed))
    cuts = staged(out.groupBy("skey").agg(F.max("epochs").alias("_epochs"), F.max(F.when(F.col("more"), F.col("key"))).alias("_cut")), "mix-cuts")
    weights = staged(quality(labels).select(F.col("doc_id").alias("_id"), F.col("weight").alias("_weight")), "mix-weights")
    rows = docs.join(broadcast_if_small(weights), F.col("doc_id") == F.col("_id"), "left").join(cuts, source_key(F.col("source")) == F.col("skey"))
    key = -F.log(uniform(F.col("doc_id"), F.col("text"), F.lit(seed))) / F.coalesce("_weight", F.lit(1.0))
    copies = F.col("_epochs") + F.coalesce((key <= F.col("_cut")).cast("int"), F.lit(0))
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*columns)


def op2_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contract columns; quality weights come from the labels table."""
    out = mix(measured(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "size", "source_size", "target", "taken")
