"""First-match bucketing of numbers into labels (one folded CASE WHEN).

NaN compares above every number in Spark, so it lands in the ``else`` arm.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat.functions._util import col


def bucketize(c, bounds, labels, *, null_label=C.MISSING, neg_label=C.NEGATIVE, else_label=C.NEGATIVE) -> Column:
    """``null -> null_label``, ``< 0 -> neg_label``, first ``c < bounds[i] -> labels[i]``, else ``else_label``.

    ``neg_label=None`` skips the negative arm.
    """
    if len(bounds) != len(labels):
        raise ValueError("bounds and labels must have the same length")
    c = col(c)
    expr = F.when(c.isNull(), F.lit(null_label))
    if neg_label is not None:
        expr = expr.when(c < 0.0, F.lit(neg_label))
    for bound, label in zip(bounds, labels):
        expr = expr.when(c < bound, F.lit(label))
    return expr.otherwise(F.lit(else_label))


def _gsd(c, prefix) -> Column:
    return bucketize(
        c, C.GSD_BOUNDS, [prefix + s for s in C.GSD_SUFFIXES], else_label=prefix + C.GSD_INF_SUFFIX
    )


def gsd_bucket_h(ires) -> Column:
    """Horizontal ground-sample-distance bucket of an ires value (feet)."""
    return _gsd(ires, "hGSD")


def gsd_bucket_v(ires) -> Column:
    """Vertical ground-sample-distance bucket of an ires value (feet)."""
    return _gsd(ires, "vGSD")


def time_of_day_bucket(phi) -> Column:
    """Time of day from the solar angle; ``< 0`` and ``>= 180`` give ``-``."""
    return bucketize(phi, C.TIME_OF_DAY_BOUNDS, C.TIME_OF_DAY_LABELS)


def look_angle_bucket(phi) -> Column:
    """15-degree look-angle bucket ``00-15`` .. ``75-90``; out of range is ``Missing``."""
    return bucketize(phi, C.LOOK_ANGLE_BOUNDS, C.LOOK_ANGLE_LABELS, neg_label=C.MISSING, else_label=C.MISSING)


def look_angle_legacy_bucket(phi) -> Column:
    """Legacy look-angle bucket ``LA1`` .. ``LA6``; out of range is ``Missing``."""
    return bucketize(
        phi, C.LOOK_ANGLE_BOUNDS, C.LOOK_ANGLE_LEGACY_LABELS, neg_label=C.MISSING, else_label=C.MISSING
    )
