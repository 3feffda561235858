"""Versioning, dedup and fill-from-siblings.

Per-group values are computed as partial aggregates joined back on the key
(null keys form a group, as they would in a window) instead of whole-group
windows, so a hot key is reduced on the map side.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqcat.operators._join import null_safe_join
from seqcat.operators.ranks import exact_row_number


def _keys(key):
    return [key] if isinstance(key, str) else list(key)


def version_number(df: DataFrame, key="sequence_id", order_cols=("modified", "filepath"),
                   out: str = "version") -> DataFrame:
    """1-based version per key in ascending ``order_cols`` (oldest = 1)."""
    return exact_row_number(df, _keys(key), list(order_cols), out=out)


_ATOMIC = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
           T.BinaryType)


def latest_row_agg(df: DataFrame, key, order_cols):
    """``(keys, aggregate)``: ``max_by(row, order)`` where the row's atomic columns break ties."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    ties = [f.name for f in df.schema.fields
            if f.name not in keys and f.name not in order_cols and isinstance(f.dataType, _ATOMIC)]
    order = F.struct(*[F.col(c) for c in [*order_cols, *ties]])
    return keys, F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_m")


def latest_per_key(df: DataFrame, key="sequence_id", order_cols=("modified", "filepath")) -> DataFrame:
    """Keep the newest row per key (largest ``order_cols``; the row's atomic columns break ties).

    One ``max_by(row, order)`` aggregate: partial on the map side, one row per
    key after the shuffle.  Equals keeping ``row_number() desc == 1``.
    """
    keys, agg = latest_row_agg(df, key, order_cols)
    return df.groupBy(*keys).agg(agg).select(*keys, "_m.*").select(*df.columns)


def potential_dupes(df: DataFrame, id_col: str = "sequence_id", hash_col: str = "md5_hash",
                    count_out: str = "potential_dupe_count", first_out: str = "first_potential_dupe") -> DataFrame:
    """Rows with the same content hash as other ids.

    Adds the number of *other* distinct ids with the same hash and the smallest
    of them.  Null hashes are nobody's duplicate (both columns null).  The
    member list itself is the hash group (join on ``hash_col``); it is not
    materialised per row, which would grow with the square of a group.
    The distinct (hash, id) rows are shuffled once: the count and the two
    smallest ids (``row_number() <= 2``, cut to two rows per hash and task before
    the second shuffle) both read them.  ``df`` is read once more for its own
    rows: pass a stored table (e.g. the video catalogue), not a plan that
    recomputes the hashes.
    """
    pairs = df.where(F.col(hash_col).isNotNull()).select(F.col(hash_col).alias("_hash"), F.col(id_col).alias("_id")).distinct()
    counts = pairs.groupBy("_hash").agg(F.count(F.lit(1)).alias("_cnt"))
    smallest = Window.partitionBy("_hash").orderBy(F.col("_id").asc_nulls_last())
    two = (pairs.withColumn("_place", F.row_number().over(smallest)).where(F.col("_place") <= 2)
           .groupBy("_hash").agg(F.min("_id").alias("_m1"), F.max(F.when(F.col("_place") == 2, F.col("_id"))).alias("_m2")))
    stats = counts.join(two, "_hash")
    out = df.join(stats, df[hash_col] == stats["_hash"], "left")
    return (out.withColumn(count_out, F.col("_cnt") - 1)
            .withColumn(first_out, F.when(F.col(id_col) == F.col("_m1"), F.col("_m2")).otherwise(F.col("_m1")))
            .drop("_hash", "_cnt", "_m1", "_m2")
            .select(*df.columns, count_out, first_out))


def dupe_members(df: DataFrame, id_col: str = "sequence_id", hash_col: str = "md5_hash") -> DataFrame:
    """``(hash, id)`` for every id whose content hash is shared with another id.

    The exact member lists behind ``potential_dupes``, one row per member
    (linear in the data, never all pairs); join on ``hash_col`` to list a
    clip's duplicates.
    """
    pairs = df.where(F.col(hash_col).isNotNull()).select(hash_col, id_col).distinct()
    shared = pairs.groupBy(hash_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(hash_col)
    return pairs.join(shared, hash_col, "left_semi")


def fill_from_group(df: DataFrame, key: str = "src_record_key", names=("width", "height"),
                    pix_suffix: str = "_pix", drop_pix: bool = True) -> DataFrame:
    """Fill ``<name>`` from ``<name><pix_suffix>``, then from the max of either over the key's group.

    Values are cast to int *before* the max, so text is not compared lexicographically.
    """
    keys = _keys(key)
    as_int = lambda c: F.col(c).try_cast("double").try_cast("int")
    aggs = []
    for n in names:
        aggs += [F.max(as_int(n)).alias(f"_gmax_{n}"), F.max(as_int(n + pix_suffix)).alias(f"_gmaxpix_{n}")]
    out = null_safe_join(df, df.groupBy(*keys).agg(*aggs), keys, "left")
    out = out.withColumns({
        n: F.coalesce(as_int(n), as_int(n + pix_suffix), F.col(f"_gmax_{n}"), F.col(f"_gmaxpix_{n}"))
        for n in names})
    helpers = [f"_gmax_{n}" for n in names] + [f"_gmaxpix_{n}" for n in names]
    if drop_pix:
        helpers += [n + pix_suffix for n in names]
    return out.drop(*helpers)
