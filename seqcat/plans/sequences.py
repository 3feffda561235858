"""Plan B: catalogues -> merged sequences -> enriched -> split."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat.functions.classify import binary_class, classify_first_match, clip_seconds, keyword_flag
from seqcat.functions.split import split_assign, split_bucket, split_key, split_timestamp
from seqcat.functions.times import ingest_date
from seqcat.operators.filters import source_allowlist
from seqcat.operators.joins import merge_sources
from seqcat.operators.jsonx import expand_json
from seqcat.operators.layout import cluster_by_key, distinct_rows
from seqcat.operators.neighbours import neighbours
from seqcat.operators.project import coalesce_counts, const_cols, prefix_cols, recast_cols, sum_matching_cols
from seqcat.operators.rollup import max_per_group
from seqcat.operators.windows import fill_from_group, latest_per_key, potential_dupes

_LATEST = ("modified", "filepath")


def sequence_table(seq_docs: DataFrame, schema=None) -> DataFrame:
    """Sequence descriptions with ``metadata``/``src_metadata`` flattened (``heigth`` fixed to ``height``)."""
    seq = expand_json(seq_docs, "src_json", "metadata", "src_metadata", schema=schema, keep_source=False)
    return seq.withColumnsRenamed({"heigth": "height"} if "heigth" in seq.columns else {})


def merge_catalogue(seq: DataFrame, parsed_frames: DataFrame, stills: DataFrame, videos: DataFrame,
                    allowed_sources=C.ALLOWED_DATA_SOURCES, fps_as_int: bool = False) -> DataFrame:
    """One row per sequence: description ⟕ telemetry summary ⟕ newest stills ⟕ newest video (with
    duplicate-content facts); sizes summed, dimensions filled from siblings, counts coalesced.

    ``fps_as_int=True`` truncates the stream's own ``fps`` to an integer before it
    serves as the fallback frame rate (the original behaviour); by default the
    fraction is kept."""
    base = prefix_cols(latest_per_key(seq, "sequence_id", _LATEST), "seq_metadata", drop_modified=False)
    frames = prefix_cols(parsed_frames, "mapp_metadata")
    jpegs = prefix_cols(latest_per_key(stills, "sequence_id", _LATEST), "jpegs")
    mp4s = potential_dupes(latest_per_key(videos, "sequence_id", _LATEST), "sequence_id", "md5_hash")
    mp4s = prefix_cols(mp4s.drop("md5_hash"), "mp4s")
    df = merge_sources(base, [frames, jpegs, mp4s], "sequence_id")
    df = sum_matching_cols(df)
    if fps_as_int and "fps" in df.columns:
        df = df.withColumn("fps", F.col("fps").try_cast("double").try_cast("int"))
    df = fill_from_group(df, "src_record_key", ["width", "height"])
    df = coalesce_counts(recast_cols(df))
    df = df.withColumn("ingest_date", ingest_date("modified")).drop("modified")
    return source_allowlist(df, "data_source", allowed_sources)


def described(df: DataFrame) -> DataFrame:
    """Batch, maritime flag, mission type, line of effort and the batch's ``max_frame_count``; deduplicated."""
    df = df.withColumn("batch", F.col("seq_metadata_batch_path"))
    df = df.withColumn("is_maritime", keyword_flag("seq_metadata_filepath", "src_record_key"))
    df = df.withColumn("mission_type", classify_first_match(C.MISSION_TYPE_RULES, C.MISSION_TYPE_DEFAULT))
    df = df.withColumn("loe", binary_class("mission_type"))
    return distinct_rows(max_per_group(df, "batch", "frame_count", "max_frame_count"))


def with_neighbours(df: DataFrame, clips: DataFrame | None = None) -> DataFrame:
    """``described`` rows with their neighbouring clips, in place of ``max_frame_count``.  ``clips`` has the rows that candidates come
    from, if these aren't ``df`` itself."""
    at = df.columns.index("max_frame_count")
    names = ["next_sequence_id", "prev_sequence_id"]
    out = neighbours(df, length=clip_seconds(F.col("max_frame_count")), distinct=True, clips=clips)
    return out.select(*df.columns[:at], *names, *df.columns[at + 1:])


def enrich(df: DataFrame, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Batch, maritime flag, mission type, line of effort, neighbouring clips; deduplicated and clustered by recording.

    The neighbours come last: n next and m previous candidates make n * m rows of a clip, so rows and
    candidates are deduplicated and clustered before, and the fan-out is neither shuffled nor sorted.  ``finish``, such as ``split``,
    adds columns that need no neighbours: once a clip, before the fan-out."""
    df = described(df)
    df = df if finish is None else finish(df)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # not merged by size: few rows may fan out to many
    df = cluster_by_key(df, sort_by=("src_record_key", "time_offset_s", "sequence_id"), num_partitions=tasks)
    return with_neighbours(df)


def split(df: DataFrame, mode: str = "murmur3") -> DataFrame:
    """Stable split by recording (fallback: batch) plus the split bookkeeping columns."""
    df = df.withColumn("split_key", split_key("src_record_key", "batch"))
    df = df.withColumn("split", split_assign(split_bucket("split_key", mode)))
    df = const_cols(df, {"split_strategy": C.SPLIT_STRATEGY, "split_status": C.SPLIT_STATUS})
    return df.withColumn("split_timestamp", split_timestamp("ingest_date")).withColumn(
        "split_assigned_by", F.lit(C.SPLIT_ASSIGNED_BY))
