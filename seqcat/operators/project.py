"""Renames, constants, casts, sums and null cleaning (all single ``select``s)."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqcat import config as C


def prefix_cols(df: DataFrame, prefix: str, cols=("filepath", "filesize_bytes", "batch_path"),
                drop_modified: bool = True) -> DataFrame:
    """Rename catalogue columns to ``<prefix>_<name>`` (missing names are ignored)."""
    out = df.withColumnsRenamed({c: f"{prefix}_{c}" for c in cols if c in df.columns})
    return out.drop("modified") if drop_modified else out


def rename_cols(df: DataFrame, mapping: dict, keep=None) -> DataFrame:
    """Rename by ``mapping``; with ``keep`` (source names) select only those, in that order."""
    src = list(keep) if keep is not None else df.columns
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in src])


def const_cols(df: DataFrame, values: dict) -> DataFrame:
    """Add literal columns; a value may be ``(value, type)`` to type a null."""
    cols = {}
    for name, v in values.items():
        if isinstance(v, tuple):
            cols[name] = F.lit(v[0]).cast(v[1])
        else:
            cols[name] = F.lit(v)
    return df.withColumns(cols)


def recast_cols(df: DataFrame, cols=C.RECAST_DOUBLE_COLUMNS, to: str = "double") -> DataFrame:
    """``try_cast`` the listed columns and move them to the end (missing ones are skipped)."""
    present = [c for c in cols if c in df.columns]
    return df.select(*[c for c in df.columns if c not in present],
                     *[F.col(c).try_cast(to).alias(c) for c in present])


def sum_matching_cols(df: DataFrame, suffix: str = "_filesize_bytes", out: str = "total_filesize_bytes",
                      missing_as_zero: bool = False, drop: bool = True) -> DataFrame:
    """Sum of every column ending in ``suffix``; null if any part is null unless ``missing_as_zero``."""
    parts = [c for c in df.columns if c.endswith(suffix) and c != out]
    if not parts:
        return df.withColumn(out, F.lit(None).cast("long"))
    terms = [F.coalesce(F.col(c), F.lit(0)) if missing_as_zero else F.col(c) for c in parts]
    res = df.withColumn(out, reduce(add, terms))
    return res.drop(*parts) if drop else res


def add_label_size(df: DataFrame, total: str = "total_filesize_bytes", part: str = "label_filesize_bytes") -> DataFrame:
    """Add the label file's size to the total (a missing label counts 0) and drop it."""
    return df.withColumn(total, F.col(total) + F.coalesce(F.col(part), F.lit(0))).drop(part)


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """NaN -> null in every top-level float/double column (or ``cols``)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols}) if cols else df


def replace_sentinel(df: DataFrame, sentinel: str = C.SENTINEL_NONE, replacement: str = "", subset=None) -> DataFrame:
    """Whole-cell replace of ``sentinel`` in string columns (substrings are left alone)."""
    if subset is None:
        subset = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not subset:
        return df
    return df.withColumns({c: F.when(F.col(c) == sentinel, F.lit(replacement)).otherwise(F.col(c)) for c in subset})


def coalesce_counts(df: DataFrame, targets=None, drop=("seq_fps", "seq_nb_frames"),
                    rename=None) -> DataFrame:
    """``fps <- coalesce(seq_fps, fps)``, ``frame_count <- coalesce(seq_nb_frames, frame_count)``,
    drop the preferred sources, rename ``nb_frames`` to ``srk_frame_count``.
    """
    targets = {"fps": ["seq_fps", "fps"], "frame_count": ["seq_nb_frames", "frame_count"]} \
        if targets is None else targets
    rename = {"nb_frames": "srk_frame_count"} if rename is None else rename
    present = lambda names: [F.col(n) for n in names if n in df.columns]
    out = df.withColumns({t: F.coalesce(*present(srcs)) for t, srcs in targets.items() if present(srcs)})
    out = out.drop(*drop)
    return out.withColumnsRenamed({a: b for a, b in rename.items() if a in out.columns})
