"""Join helpers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (``<=>``), keeping one copy of the keys.

    Used where a group-by result is attached back to its rows: ``groupBy``
    treats null as a group, so the join must too.
    """
    keys = list(keys)
    tmp = {k: f"__r_{k}" for k in keys}
    right = right.select(*[F.col(k).alias(tmp[k]) for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        part = left[k].eqNullSafe(right[tmp[k]])
        cond = part if cond is None else cond & part
    return left.join(right, cond, how).drop(*tmp.values())
