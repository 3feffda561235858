"""Path and key helpers."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqcat.functions._util import col


def file_name(path) -> Column:
    """Last ``/`` segment of a path."""
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def seq_id_from_path(path) -> Column:
    """Base name without its last extension (``os.path.splitext`` rules: leading dots are not an extension)."""
    base = file_name(path)
    has_ext = base.rlike(r"^.*[^.].*\.[^.]*$")
    return F.when(has_ext, F.regexp_extract(base, r"^(.*[^.].*)\.[^.]*$", 1)).otherwise(base)


def batch_from_path(path, index: int) -> Column:
    """``index``-th (0-based) ``/`` segment; null when out of range."""
    return F.get(F.split(col(path), "/"), F.lit(index))


def strip_ext(c, ext: str = ".mp4") -> Column:
    """Remove every occurrence of ``ext``."""
    return F.regexp_replace(col(c), re.escape(ext), "")


def composite_key(*cols, sep: str = "-") -> Column:
    """Columns joined by ``sep``; nulls are skipped."""
    return F.concat_ws(sep, *[col(c).cast("string") for c in cols])
