"""Rule-table classifiers."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat.functions._util import col


def _condition(kind, column, arg) -> Column:
    c = col(column)
    if kind == "in":
        return c.isin(list(arg))
    if kind == "not_in":
        return ~c.isin(list(arg))
    if kind == "contains":
        return c.contains(arg)
    if kind == "rlike":
        return c.rlike(arg)
    if kind == "flag":
        return c
    raise ValueError(f"unknown rule kind {kind!r}")


def classify_first_match(rules, default) -> Column:
    """Ordered first-match classifier.

    ``rules`` is a list of ``(label, [(kind, column, arg), ...])``; all
    conditions of a rule must hold.  Unknown (null) conditions do not match.
    """
    expr = None
    for label, conditions in rules:
        cond = None
        for kind, column, arg in conditions:
            part = _condition(kind, column, arg)
            cond = part if cond is None else cond & part
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def keyword_flag(text, key="src_record_key", *, substrings=C.MARITIME_SUBSTRINGS, marker=C.EDGE_MARKER,
                 excluded_keys=C.EDGE_FT_SRKS) -> Column:
    """True when ``text`` holds any of ``substrings``, or holds ``marker`` and ``key`` is not excluded.

    Null inputs give false.
    """
    t = col(text)
    has_keyword = t.rlike("(" + "|".join(re.escape(s) for s in substrings) + ")")
    cond = has_keyword
    if marker is not None:
        cond = cond | (t.contains(marker) & ~col(key).isin(list(excluded_keys)))
    return F.coalesce(cond, F.lit(False))


def binary_class(c, needle: str = C.LOE_MARKER, match: str = C.LOE_MATCH, other: str = C.LOE_OTHER) -> Column:
    """``match`` when ``c`` contains ``needle``, else (also for null) ``other``."""
    return F.when(col(c).contains(needle), F.lit(match)).otherwise(F.lit(other))


def clip_seconds(frame_count, seconds_by_frames=None, default=C.CLIP_SECONDS_DEFAULT) -> Column:
    """Clip length in seconds from a frame count (900 -> 30, 240 -> 8, else 5)."""
    seconds_by_frames = C.CLIP_SECONDS_BY_FRAMES if seconds_by_frames is None else seconds_by_frames
    fc = col(frame_count)
    expr = None
    for frames, seconds in seconds_by_frames.items():
        expr = F.when(fc == frames, F.lit(seconds)) if expr is None else expr.when(fc == frames, F.lit(seconds))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
