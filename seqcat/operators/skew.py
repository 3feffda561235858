"""Hot-group detection.

A group with more than ``threshold`` rows is *hot*.  One frequent-items sketch over the key hashes (merged from the
tasks, no shuffle by key) names at most ``SKETCH_ITEMS`` candidates; only their rows are counted exactly.  The sketch holds every
key with more than rows / (0.75 x ``SKETCH_ITEMS``) rows, so up to 49 billion rows at the default threshold no hot
group escapes it; beyond that a group counts as hot from that share on.  Being hot or not changes the plan, never the result.

The table of hot keys has at most ``SKETCH_ITEMS`` rows, so it may be broadcast.  Nothing is collected.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat.operators._join import null_safe_join
from seqcat.session import stored_counted


def hot_key_table(df: DataFrame, keys, threshold: int) -> DataFrame | None:
    """Keys of groups with more than ``threshold`` rows as a stored table, or None when there are none."""
    keys, n = list(keys), C.SKETCH_ITEMS
    if df.count() <= threshold:  # no group is larger than the table
        return None
    hashed = df.select(F.xxhash64(*keys).alias("_h"))
    top = hashed.agg(F.expr(f"approx_top_k(_h, {n}, {n})").alias("_top")).select(F.inline("_top"))  # estimates are never too low
    top, found = stored_counted(top.where(F.col("count") > threshold).select(F.col("item").alias("_item")), "hot-candidates")
    if not found:
        return None
    rows = df.select(*keys).join(F.broadcast(top), F.xxhash64(*keys) == F.col("_item"), "left_semi")
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot, found = stored_counted(counts.where(F.col("_rows") > threshold).select(*keys), "hot-keys")
    return hot if found else None


def split_hot(df: DataFrame, keys, hot: DataFrame):
    """``(cold_rows, hot_rows)`` of ``df`` by the hot keys (null-safe broadcast joins, see above for their number)."""
    small = F.broadcast(hot)
    return null_safe_join(df, small, keys, "left_anti"), null_safe_join(df, small, keys, "left_semi")
