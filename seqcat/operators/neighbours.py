"""Contiguous clips of the same recording.

Clip ``b`` follows clip ``a`` when both share the recording key and
``offset(b) - clip_length(b) == offset(a)`` (``prev`` is the mirror).  The
clip length comes from the *candidate's* batch.  Offsets are compared as
rounded milliseconds (bigint), not as doubles.  This is a plain equi-join on
``(key, offset_ms)``: a hot recording spreads over its offsets.

The wide side is dealt out by ``(key, offset_ms)`` once for both directions; a
direction deals out three narrow columns.

A slot (a recording's offset) with more than one clip is crowded, and
``crowded_slots`` lists these.  By default their clips fan out, as in the original:
a row with n next and m previous candidates becomes n * m rows.  With
``fan_out=False`` the candidates of a slot are first reduced to the smallest id
and their number (partial aggregates, so a hot slot is one row a task), and every
row of the input stays one row.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat.functions._util import col as _col
from seqcat.functions.classify import clip_seconds


def _ms(c):
    return F.round(_col(c).cast("double") * 1000).cast("bigint")


def _candidates(df: DataFrame, direction: str, id_col: str, key: str, offset: str, length, out: str) -> DataFrame:
    step = 1 if direction == "next" else -1
    return df.select(
        F.col(key).alias(f"_{out}_k"),
        (_ms(offset) - F.round(length.cast("double") * 1000).cast("bigint") * step).alias(f"_{out}_ms"),
        F.col(id_col).alias(out),
    )


def _one_per_slot(cand: DataFrame, out: str) -> DataFrame:
    slots = cand.where(F.col(f"_{out}_k").isNotNull() & F.col(f"_{out}_ms").isNotNull())
    return slots.groupBy(f"_{out}_k", f"_{out}_ms").agg(F.min(out).alias(out), F.count(F.lit(1)).alias(f"{out}_count"))


def _attach(base: DataFrame, cand: DataFrame, key: str, out: str) -> DataFrame:
    cond = (base[key] == cand[f"_{out}_k"]) & (base["_bms"] == cand[f"_{out}_ms"])
    return base.join(cand, cond, "left").drop(f"_{out}_k", f"_{out}_ms")


def neighbours(df: DataFrame, directions=("next", "prev"), *, id_col: str = "sequence_id",
               key: str = "src_record_key", offset: str = "time_offset_s", length=None,
               fan_out: bool = True, distinct: bool = False, clips: DataFrame | None = None) -> DataFrame:
    """Attach ``<direction>_<id_col>`` for each direction; null when there is none.

    Candidates of every direction come from the original rows, or from ``clips``.  ``length`` is a
    Column giving the clip length in seconds, evaluated on the candidate row
    (default: ``clip_seconds(max_frame_count)``).  ``fan_out=False`` attaches the
    smallest id and ``<direction>_<id_col>_count`` (0 when there is none) instead
    of one row per candidate.  Rows without a key or offset have no neighbours.
    With ``distinct`` a clip that stands in a slot twice is one candidate: distinct rows then give distinct rows, and
    no duplicate has to be removed after the fan-out.
    """
    length = clip_seconds(F.col("max_frame_count")) if length is None else length
    out = df.withColumn("_bms", _ms(offset))
    for direction in directions:
        if direction not in ("next", "prev"):
            raise ValueError("direction must be 'next' or 'prev'")
        name = f"{direction}_{id_col}"
        cand = _candidates(df if clips is None else clips, direction, id_col, key, offset, length, name)
        cand = cand.distinct() if distinct and fan_out else cand
        out = _attach(out, cand if fan_out else _one_per_slot(cand, name), key, name)
        if not fan_out:
            out = out.withColumn(f"{name}_count", F.coalesce(f"{name}_count", F.lit(0).cast("long")))
    return out.drop("_bms")


def neighbour(df: DataFrame, direction: str = "next", **kw) -> DataFrame:
    """One direction: ``next_<id>`` or ``prev_<id>``."""
    return neighbours(df, (direction,), **kw)


def crowded_slots(df: DataFrame, *, id_col: str = "sequence_id", key: str = "src_record_key",
                  offset: str = "time_offset_s") -> DataFrame:
    """``(key, offset_ms, n_clips, first_<id>)`` of every slot that holds more than one clip: where ``neighbours`` fans
    out.  One partial aggregate; rows without a key or offset are in no slot."""
    slots = df.select(F.col(key), _ms(offset).alias("offset_ms"), F.col(id_col)).where(
        F.col(key).isNotNull() & F.col("offset_ms").isNotNull())
    return slots.groupBy(key, "offset_ms").agg(F.count(F.lit(1)).alias("n_clips"), F.min(id_col).alias(f"first_{id_col}")).where(
        F.col("n_clips") > 1)
