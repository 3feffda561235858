"""Null-aware scalar helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqcat.functions._util import col


def quality_score(cols, digits: int = 2) -> Column:
    """Share of the given columns that are non-null, rounded."""
    if not cols:
        raise ValueError("quality_score needs at least one column")
    present = None
    for c in cols:
        term = col(c).isNotNull().cast("int")
        present = term if present is None else present + term
    return F.round(present.cast("double") / F.lit(float(len(cols))), digits)


def labeled_objects(categories) -> Column:
    """Number of distinct categories; null (not -1, not an error) when unlabelled."""
    c = col(categories)
    return F.when(c.isNotNull(), F.size(c))


def is_labeled(c) -> Column:
    """True when the column is non-null."""
    return col(c).isNotNull()
