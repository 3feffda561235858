"""Distributed file sources and stage tables."""

from seqcat.sources.files import (
    file_catalogue,
    first_file_per_dir,
    folder_files,
    json_documents,
    label_documents,
    label_listing,
    sequence_documents,
    still_files,
    telemetry_documents,
    video_files,
)
from seqcat.sources.tables import dim_read, export_csv, stage_read, stage_write

__all__ = [
    "file_catalogue", "first_file_per_dir", "folder_files", "json_documents", "label_documents", "label_listing", "sequence_documents",
    "still_files", "telemetry_documents", "video_files", "dim_read", "export_csv", "stage_read", "stage_write",
]
