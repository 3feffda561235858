"""Run plans A, B and C in one session and keep the tables as Parquet."""

from pyspark.sql import SparkSession

from seqcat import schemas
from seqcat.operators.boxes import bbox_union
from seqcat.operators.jsonx import malformed_documents
from seqcat.operators.neighbours import crowded_slots
from seqcat.plans.annotations import (
    annotation_rows,
    label_table,
    label_tasks,
    rejected_annotations,
    sequences_with_labels,
)
from seqcat.plans.sequences import enrich, merge_catalogue, sequence_table, split
from seqcat.plans.telemetry import flat_frames, frames_with_context, sequences_from_frames
from seqcat.session import stored
from seqcat.sources import (
    dim_read,
    label_documents,
    sequence_documents,
    stage_read,
    stage_write,
    still_files,
    telemetry_documents,
    video_files,
)


def build_catalogue(spark: SparkSession, raw_root: str, label_folder: str, ontology_csv: str, out_root: str,
                    *, seq_schema=None, frame_schema=None) -> dict:
    """Build the frame, sequence, label and final tables under ``out_root``; return their paths,
    ``rejected_annotations`` (annotations of other types, which carry no box) and ``malformed_documents``
    (telemetry and label files that hold no JSON of the expected kind, so give no row).  ``crowded_slots`` lists the
    offsets of a recording that hold several clips, where rows fan out over their neighbours.

    ``frame_schema`` (an array of frames) and ``seq_schema`` declare the documents and spare the pass that infers
    their open fields.

    Intermediate tables are written and read back: this cuts lineage (a lost
    executor re-runs only its own stage) and keeps costly inputs, such as the
    video bytes behind the md5, from being read again by every branch of a
    later plan.
    """
    out = out_root.rstrip("/")
    paths = {k: f"{out}/{k}" for k in ("videos", "stills", "frames_flat", "frames", "telemetry", "merged",
                                       "crowded_slots", "sequences", "annotations", "label_tasks", "labels", "catalogue")}

    # file catalogues first: one small row per file, so the video bytes are read (hashed) exactly once
    stage_write(video_files(spark, raw_root), paths["videos"])
    stage_write(still_files(spark, raw_root), paths["stills"])

    # JSON parsed once; start/end values and global averages read the stored frames
    telemetry = stored(telemetry_documents(spark, raw_root), "telemetry-documents")
    stage_write(flat_frames(telemetry, frame_schema), paths["frames_flat"])
    stage_write(frames_with_context(stage_read(spark, paths["frames_flat"])), paths["frames"],
                partition_by="batch_path")
    stage_write(sequences_from_frames(stage_read(spark, paths["frames"])), paths["telemetry"])

    merged = merge_catalogue(sequence_table(sequence_documents(spark, raw_root), seq_schema),
                             stage_read(spark, paths["telemetry"]), stage_read(spark, paths["stills"]),
                             stage_read(spark, paths["videos"]))
    # stored: enrich reads it five times (per-batch max and both neighbour sides)
    stage_write(merged, paths["merged"])
    stage_write(crowded_slots(stage_read(spark, paths["merged"])), paths["crowded_slots"])
    # batch folders (partition pruning); rows inside keep the recording/offset order of the clustering
    sequences = enrich(stage_read(spark, paths["merged"]), split)
    stage_write(sequences, paths["sequences"], partition_by="batch", sort_by=("src_record_key", "time_offset_s"))

    ontology = dim_read(spark, ontology_csv, schemas.ONTOLOGY)
    docs = stored(label_documents(spark, label_folder), "label-documents")
    # stored: boxes and the count of rejected annotations read it; the tasks decide versions in later runs
    stage_write(annotation_rows(docs), paths["annotations"])
    stage_write(label_tasks(docs), paths["label_tasks"])
    rows = stage_read(spark, paths["annotations"])
    stage_write(label_table(bbox_union(rows), ontology), paths["labels"])
    report = {"rejected_annotations": rejected_annotations(rows).count(),
              "malformed_documents": malformed_documents(telemetry, array=True).count()
              + malformed_documents(docs).count()}

    final = sequences_with_labels(stage_read(spark, paths["sequences"]), stage_read(spark, paths["labels"]))
    stage_write(final, paths["catalogue"], partition_by="batch")
    return {**paths, **report}
