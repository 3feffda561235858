"""Exact ranks inside groups of any size.

Row numbers: a plain ``Window.partitionBy(key).orderBy(...)`` puts a whole group in one task.  For hot groups the rows are
range-partitioned by (key, all order columns, row hash) instead, so a group spreads over as many tasks as it fills, whatever
the types: text, times, nulls and ties of the first columns included.  Inside a partition rows are sorted and
numbered in passing; the rows per (partition, key) are counted and summed up to offsets, and a row's number is its place
in its partition plus the offset.  Only rows that are equal in every column stay together.

Medians: the value of a given rank is narrowed down by counting.  Each round cuts the range that still holds a group's median
into ``MEDIAN_BINS`` bins of equal width (of the logarithm while the range is wide), counts rows per bin, and keeps the bin with the rank and the
exact smallest and largest value in it, until these are one value.  A bin number never decreases as the value grows, so the answer
is exact however the values lie; smallest and largest fall into different bins, so every round narrows.
Rounds need no lists and no sort, and shuffle at most ``MEDIAN_BINS`` counts per task, group and column.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat.operators._join import null_safe_join
from seqcat.operators.skew import hot_key_table, split_hot
from seqcat.session import stored, stored_counted

_PLACE_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def exact_row_number(df: DataFrame, keys, order_cols, *, out: str = "row_number", descending: bool = False,
                     n_blocks: int | None = None, hot_threshold: int = C.HOT_GROUP_ROWS) -> DataFrame:
    """``row_number() over (partition by keys order by order_cols)`` that survives hot groups.

    Cold groups use the plain window; groups above ``hot_threshold`` rows are numbered over range partitions (``n_blocks`` of
    them; the session's shuffle partitions by default).  Same numbers when ``order_cols`` is a total order inside each group.
    """
    keys, order_cols = list(keys), list(order_cols)
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    plain = lambda d: d.withColumn(out, F.row_number().over(
        Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    hot = hot_key_table(df, keys, hot_threshold)
    if hot is None:
        return plain(df)
    cold_df, hot_df = split_hot(df, keys, hot)
    return plain(cold_df).unionByName(range_row_number(hot_df, keys, order, out=out, n_parts=n_blocks))


def range_placed(df: DataFrame, keys, order, n_parts: int | None = None) -> DataFrame:
    """``df`` sorted over range partitions, stored, with ``_part`` and ``_place`` (row position in the partition)."""
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    by = [*[F.col(k) for k in keys], *order, F.xxhash64(*hashable)]
    ranged = df.repartitionByRange(n_parts, *by) if n_parts else df.repartitionByRange(*by)
    ranged = ranged.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged, "ranked")
    return ranged.withColumns({"_part": F.shiftright("_at", _PLACE_BITS),
                               "_place": F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)}).drop("_at")


def range_row_number(df: DataFrame, keys, order, *, out: str = "row_number", n_parts: int | None = None) -> DataFrame:
    """Row numbers of every group over range partitions; ``order`` are sort columns."""
    keys = list(keys)
    placed = range_placed(df, keys, order, n_parts)
    parts = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*keys, "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    out_rows = null_safe_join(placed, offsets, [*keys, "_part"])
    return out_rows.withColumn(out, (F.col("_place") + F.col("_offset") + 1).cast("long")).drop("_part", "_place", "_offset")


def _signed_log(v):
    """A double that never decreases in ``v``: sign and binary logarithm (above -1075 for any double but 0)."""
    return F.when(v == 0.0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(v)) + 1100.0))


def _bin(v, lo, hi, bins: int):
    """Bin of ``v`` in [lo, hi], lo < hi: it never decreases in ``v``, is 0 at ``lo`` and the last one at ``hi``.

    Ranges wider than a factor of two are cut by logarithm, so that a few rounds do for any doubles.
    """
    infinite = (F.abs(lo) == float("inf")) | (F.abs(hi) == float("inf"))
    ends = F.when(v == float("-inf"), F.lit(0)).when(v == float("inf"), F.lit(bins - 1)).otherwise(F.lit(1))
    wide = (lo <= 0.0) | (hi >= lo * 2.0)
    wide = wide & ~((hi < 0.0) & (lo > hi * 2.0))
    scale = F.when(F.greatest(F.abs(lo), F.abs(hi)) > 1e300, F.lit(0.25)).otherwise(F.lit(1.0))  # no overflow of the width
    scaled = [F.when(wide, _signed_log(x)).otherwise(x * scale) for x in (v, lo, hi)]
    share = (scaled[0] - scaled[1]) / F.when(infinite | (scaled[2] <= scaled[1]), F.lit(1.0)).otherwise(scaled[2] - scaled[1])
    place = F.when(v == hi, F.lit(bins - 1)).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)))
    return F.when(infinite, ends).otherwise(place).cast("int")


def select_ranks(long: DataFrame, group, value: str, rank, bins: int = C.MEDIAN_BINS) -> DataFrame:
    """(group, value) of the row at 0-based position ``rank`` of each group's sorted values.

    ``rank`` is an expression of ``_n``, the group's rows; ``long`` holds doubles without null and NaN and is
    read once a round.
    """
    group, bins = list(group), max(3, bins)
    v = F.col(value)
    state = long.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    is_open = F.col("_lo") < F.col("_hi")
    state, n_open = stored_counted(state.select(*group, "_lo", "_hi", rank.cast("long").alias("_k")), "median-ranges", is_open)
    found = []
    while True:
        found.append(state.where("_lo = _hi").select(*group, F.col("_lo").alias(value)))
        if not n_open:
            break
        rows = null_safe_join(long, F.broadcast(state.where(is_open)), group).where(v.between(F.col("_lo"), F.col("_hi")))
        rows = rows.withColumn("_bin", _bin(v, F.col("_lo"), F.col("_hi"), bins))
        counts = rows.groupBy(*group, "_bin").agg(F.count(F.lit(1)).alias("_c"), F.min(v).alias("_min"), F.max(v).alias("_max"),
                                                  F.first("_k").alias("_k"))
        upto = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_upto", F.sum("_c").over(upto)).where(
            (F.col("_upto") - F.col("_c") <= F.col("_k")) & (F.col("_k") < F.col("_upto")))
        state, n_open = stored_counted(counts.select(
            *group, F.col("_min").alias("_lo"), F.col("_max").alias("_hi"),
            (F.col("_k") - F.col("_upto") + F.col("_c")).alias("_k")), "median-ranges", is_open)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
