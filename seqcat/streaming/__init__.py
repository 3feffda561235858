"""Incremental ingest with Structured Streaming (file sources, exactly-once per file)."""

from seqcat.streaming.ingest import (
    compact_latest,
    fold_latest,
    read_epochs,
    read_latest,
    stream_ingest,
    stream_ingest_rejects,
    stream_latest,
)

__all__ = ["compact_latest", "fold_latest", "read_epochs", "read_latest", "stream_ingest", "stream_ingest_rejects", "stream_latest"]
