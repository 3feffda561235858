"""Incremental catalogue maintenance: skip what is done, append the rest."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skip_done(new: DataFrame, done: DataFrame, key: str = "batch_path", done_key: str | None = None) -> DataFrame:
    """Rows of ``new`` whose ``key`` does not occur in ``done`` (left anti join; no driver-side list)."""
    dk = done.select(F.col(done_key or key).alias("_done_key")).distinct()
    return new.join(dk, new[key] == dk["_done_key"], "left_anti")


def skip_done_files(listing: DataFrame, done: DataFrame, file_col: str = "file_name",
                    project_col: str = "project_name", suffix: str = ".json") -> DataFrame:
    """Label files not yet ingested: ``file_name`` differs from every ``project_name + suffix`` in ``done``."""
    dk = done.select(F.concat(F.col(project_col), F.lit(suffix)).alias("_done_file")).distinct()
    return listing.join(dk, listing[file_col] == dk["_done_file"], "left_anti")


def append_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` then ``new`` by column name; a column missing on one side is null there."""
    return old.unionByName(new, allowMissingColumns=True)
