"""Frames -> one row per sequence.

Mode and upper median are exact.  Groups of at most ``HOT_GROUP_ROWS`` rows take one hash aggregate; larger ones
are counted (modes per value, medians per bin, see ``ranks``), which is partial-aggregated on the map side and never holds
a whole group in one task.  Many columns are handled in one pass by unpivoting them into ``(group, _col, _v)`` rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqcat import config as C
from seqcat.operators._join import null_safe_join
from seqcat.operators.ranks import select_ranks
from seqcat.operators.skew import hot_key_table, split_hot

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _keys(key):
    return [key] if isinstance(key, str) else list(key)


def _long(df: DataFrame, keys, cols, cast: str) -> DataFrame:
    """Unpivot ``cols`` (cast to one type) into ``(keys, _col, _v)``."""
    wide = df.select(*keys, *[F.col(c).cast(cast).alias(c) for c in cols])
    return wide.unpivot(keys, list(cols), "_col", "_v")


def frame_count(df: DataFrame, key="sequence_id", out: str = "frame_count") -> DataFrame:
    """Number of rows per group."""
    return df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias(out))


def grouped_modes(df: DataFrame, key, cols, ignore=C.MODE_IGNORED) -> DataFrame:
    """Most frequent value per group of each column, ignoring null and ``ignore``; ties -> lowest value.

    Groups where a column has no valid value get null (or no row if no column has any).
    """
    keys, cols = _keys(key), list(cols)
    long = _long(df, keys, cols, "string")
    valid = F.col("_v").isNotNull()
    if ignore:
        valid = valid & ~F.col("_v").isin(list(ignore))
    hist = long.where(valid).groupBy(*keys, "_col", "_v").agg(F.count(F.lit(1)).alias("_c"))
    # min over (-count, value): highest count first, then the lowest value.
    best = F.struct((-F.col("_c")).alias("n"), F.col("_v").alias("v"))
    return hist.groupBy(*keys).agg(*[F.min(F.when(F.col("_col") == c, best)).getField("v").alias(c) for c in cols])


def grouped_upper_medians(df: DataFrame, key, cols, bins: int = C.MEDIAN_BINS) -> DataFrame:
    """Upper median per group of each column: ``sorted(v)[n // 2]`` over values that are not null, NaN or 0.

    No interpolation (``F.median`` would interpolate), no lists: the ranks are selected by counting (``ranks``).  Meant for few
    groups (the hot ones): the ranges still open, one row per group and column, are broadcast each round.
    """
    keys, cols = _keys(key), list(cols)
    v = F.col("_v")
    long = _long(df, keys, cols, "double").where(v.isNotNull() & ~F.isnan(v) & (v != 0.0))
    picked = select_ranks(long, [*keys, "_col"], "_v", F.floor(F.col("_n") / 2), bins)
    return picked.groupBy(*keys).agg(*[F.max(F.when(F.col("_col") == c, v)).alias(c) for c in cols])


def _single_pass(df: DataFrame, keys, mode_cols, median_cols, ignore, count_col) -> DataFrame:
    """All roll-ups in one aggregate: ``mode`` (deterministic: lowest value on ties) and the upper
    median as ``sorted(values)[n // 2]`` from ``array_sort(collect_list)``.

    Used for cold groups only: the count job has proven every such group to hold
    at most ``HOT_GROUP_ROWS`` rows, so each list is bounded (and the sort is
    about twice as fast as ``percentile_disc``'s value maps on large groups)."""
    prep = {}
    for i, c in enumerate(mode_cols):
        v = F.col(c).cast("string")
        prep[f"_mo{i}"] = F.when(~v.isin(list(ignore)), v) if ignore else v
    for i, c in enumerate(median_cols):
        v = F.col(c).cast("double")
        prep[f"_me{i}"] = F.when(~F.isnan(v) & (v != 0.0), v)
    slim = df.select(*keys, *[e.alias(n) for n, e in prep.items()])
    aggs = [F.count(F.lit(1)).alias(count_col or "_rows")]
    aggs += [F.mode(f"_mo{i}", True).alias(c) for i, c in enumerate(mode_cols)]
    for i, c in enumerate(median_cols):
        ordered = F.array_sort(F.collect_list(f"_me{i}"))  # nulls (and NaN/0, nulled above) are skipped
        aggs.append(F.try_element_at(ordered, (F.floor(F.size(ordered) / 2) + 1).cast("int")).alias(c))
    out = slim.groupBy(*keys).agg(*aggs)
    return out if count_col else out.drop("_rows")


def _spread_path(df: DataFrame, keys, mode_cols, median_cols, ignore, count_col, bins: int) -> DataFrame:
    """Roll-up of hot groups by counting (never one task, one map or one list per group)."""
    out = frame_count(df, keys, count_col or "_rows")
    if mode_cols:
        out = null_safe_join(out, grouped_modes(df, keys, mode_cols, ignore), keys, "left")
    if median_cols:
        out = null_safe_join(out, grouped_upper_medians(df, keys, median_cols, bins), keys, "left")
    out = out.select(*keys, count_col or "_rows", *mode_cols, *median_cols)
    return out if count_col else out.drop("_rows")


def rollup(df: DataFrame, key, mode_cols=(), median_cols=(), *, ignore=C.MODE_IGNORED,
           count_col: str | None = "frame_count", hot_threshold: int = C.HOT_GROUP_ROWS,
           n_blocks: int = C.MEDIAN_BINS) -> DataFrame:
    """Per group: row count, clean mode of ``mode_cols``, upper median of ``median_cols``.

    Groups above ``hot_threshold`` rows are split off and rolled up by counting (``n_blocks`` bins a round); the rest in
    one hash aggregate.  Without hot groups the plan is a single shuffle.
    """
    keys, mode_cols, median_cols = _keys(key), list(mode_cols), list(median_cols)
    hot = hot_key_table(df, keys, hot_threshold)
    if hot is None:
        return _single_pass(df, keys, mode_cols, median_cols, ignore, count_col)
    cold_df, hot_df = split_hot(df, keys, hot)
    cold = _single_pass(cold_df, keys, mode_cols, median_cols, ignore, count_col)
    return cold.unionByName(_spread_path(hot_df, keys, mode_cols, median_cols, ignore, count_col, n_blocks))


def mode_clean(df: DataFrame, key, col: str, out: str | None = None, **kw) -> DataFrame:
    """One row per group with the clean mode of ``col``."""
    res = rollup(df, key, [col], [], count_col=None, **kw)
    return res.withColumnRenamed(col, out) if out else res


def upper_median(df: DataFrame, key, col: str, out: str | None = None, **kw) -> DataFrame:
    """One row per group with the upper median of ``col``."""
    res = rollup(df, key, [], [col], count_col=None, **kw)
    return res.withColumnRenamed(col, out) if out else res


def modes_and_medians(df: DataFrame, key="sequence_id", *, mode_cols=None, median_cols=None,
                      force_mode=C.FORCE_MODE_COLUMNS, exclude=("sequence_frame",),
                      count_col: str = "frame_count", **kw) -> DataFrame:
    """Roll frames up to one row per group: row count, mode of text columns, upper median of numbers.

    Defaults: string columns and ``force_mode`` columns -> mode (forced ones are
    cast back to int), other numeric columns -> upper median; nested, boolean
    and timestamp columns are left out.  Pass ``mode_cols``/``median_cols`` to choose.
    """
    keys = _keys(key)
    skip = set(keys) | set(exclude)
    fields = [f for f in df.schema.fields if f.name not in skip]
    forced = [c for c in force_mode if c in df.columns and c not in skip]
    if mode_cols is None:
        mode_cols = [f.name for f in fields if isinstance(f.dataType, T.StringType)] + forced
    if median_cols is None:
        median_cols = [f.name for f in fields
                       if isinstance(f.dataType, _NUMERIC) and f.name not in forced and f.name not in mode_cols]
    out = rollup(df, keys, mode_cols, median_cols, count_col=count_col, **kw)
    casts = {c: F.col(c).try_cast("double").try_cast("int") for c in forced if c in mode_cols}
    return out.withColumns(casts) if casts else out


def global_averages(df: DataFrame, cols=C.GLOBAL_AVERAGE_COLUMNS, prefix: str = "global_average_") -> DataFrame:
    """Attach the average of each column over all rows to every row.

    The averages are one partial-aggregated row (its size does not grow with
    the data); it is fetched and attached as literals, so the row plan stays a
    projection (no join, no constant-key shuffle).
    """
    agg = df.agg(*[F.avg(c).alias(prefix + c) for c in cols]).first()
    return df.withColumns({prefix + c: F.lit(agg[prefix + c]).cast("double") for c in cols})


def max_per_group(df: DataFrame, group: str, col: str, out: str) -> DataFrame:
    """Attach ``max(col)`` of the row's group; rows with a null group get null.

    Plain equi-join: AQE broadcasts the per-group table when it is small at
    run time and otherwise sort-merges (splitting a skewed group).
    """
    agg = df.groupBy(group).agg(F.max(col).alias(out))
    return df.join(agg, group, "left")


def starts_and_ends(df: DataFrame, key="sequence_id", frame: str = "sequence_frame", cols=C.START_END_COLUMNS,
                    first: int = C.FIRST_FRAME, last: int | None = C.LAST_FRAME) -> DataFrame:
    """Attach ``start_<c>`` (value at frame ``first``) and ``end_<c>`` (at frame ``last``) per group.

    ``last=None`` takes the value at the group's highest frame.  Computed as a
    partial aggregate joined back on the key (null keys form a group, as in a window).
    """
    keys = _keys(key)
    f = F.col(frame)
    aggs = []
    for c in cols:
        aggs.append(F.max(F.when(f == first, F.col(c))).alias(f"start_{c}"))
        if last is None:
            aggs.append(F.max_by(F.col(c), f).alias(f"end_{c}"))
        else:
            aggs.append(F.max(F.when(f == last, F.col(c))).alias(f"end_{c}"))
    return null_safe_join(df, df.groupBy(*keys).agg(*aggs), keys, "left")
