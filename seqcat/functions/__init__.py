"""Column -> Column functions (all built-in Spark expressions, codegen-friendly)."""

from seqcat.functions.angles import avg_of, elevation_angle_degree, look_angle
from seqcat.functions.buckets import (
    bucketize,
    gsd_bucket_h,
    gsd_bucket_v,
    look_angle_bucket,
    look_angle_legacy_bucket,
    time_of_day_bucket,
)
from seqcat.functions.classify import binary_class, classify_first_match, clip_seconds, keyword_flag
from seqcat.functions.nulls import is_labeled, labeled_objects, quality_score
from seqcat.functions.split import split_assign, split_bucket, split_key, split_timestamp
from seqcat.functions.strings import batch_from_path, composite_key, file_name, seq_id_from_path, strip_ext
from seqcat.functions.times import ingest_date, ts_cast

__all__ = [
    "avg_of", "elevation_angle_degree", "look_angle",
    "bucketize", "gsd_bucket_h", "gsd_bucket_v", "look_angle_bucket", "look_angle_legacy_bucket",
    "time_of_day_bucket",
    "binary_class", "classify_first_match", "clip_seconds", "keyword_flag",
    "is_labeled", "labeled_objects", "quality_score",
    "split_assign", "split_bucket", "split_key", "split_timestamp",
    "batch_from_path", "composite_key", "file_name", "seq_id_from_path", "strip_ext",
    "ingest_date", "ts_cast",
]
