"""seqcat: a Spark-native catalogue engine for short recorded clips.

Every public operator is either ``f(df, ...) -> DataFrame`` (use it with
``df.transform``) or ``f(col, ...) -> Column``.  Nothing here creates a
session or touches data at import time; pass your own ``SparkSession``.
"""

__version__ = "0.1.0"
