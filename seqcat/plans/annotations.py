"""Plan C: annotation documents -> one row per object and frame -> ontology -> labels on sequences."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat import schemas
from seqcat.functions.times import ingest_date
from seqcat.operators._join import null_safe_join
from seqcat.operators.boxes import bbox_union
from seqcat.operators.incremental import append_union, skip_done
from seqcat.operators.joins import add_ontology
from seqcat.operators.jsonx import parse_json
from seqcat.operators.labels import (
    annotation_struct,
    explode_annotations,
    explode_objects,
    explode_tasks,
    first_label,
    keep_latest_label,
    label_join,
    label_primary_key,
    rename_label_document,
)
from seqcat.operators.project import const_cols

_ORDER = ("download_date", "filepath")


def _tasks(docs: DataFrame, schema) -> DataFrame:
    parsed = parse_json(docs, "src_json", schema, out="_doc")
    return explode_tasks(rename_label_document(parsed.select("filepath", "modified", "filesize_bytes", "_doc.*")))


def label_tasks(docs: DataFrame, schema=schemas.LABEL_DOCUMENT, key: str = "sequence_id", order=_ORDER) -> DataFrame:
    """Number of tasks ``n`` per sequence and document, those without annotations included.  Kept as a table, it
    decides later which document of a sequence is the newest."""
    return _tasks(docs, schema).groupBy(key, *order).agg(F.count(F.lit(1)).alias("n"))


def keep_newest_documents(rows: DataFrame, tasks: DataFrame, key: str = "sequence_id", order=_ORDER) -> DataFrame:
    """Rows of each sequence's newest document (largest ``order``) among ``tasks``, with its version: the number of
    tasks.  A newest document without rows leaves the sequence without any."""
    newest = tasks.groupBy(key).agg(F.max(F.struct(*order)).alias("_v"), F.sum("n").cast("int").alias("_version"))
    newest = newest.select(key, *[F.col(f"_v.{c}").alias(c) for c in order], "_version")
    out = null_safe_join(rows, newest, [key, *order], "inner")
    return out.withColumn("label_version", F.col("_version")).select(*rows.columns)


def annotation_rows(docs: DataFrame, schema=schemas.LABEL_DOCUMENT, key_cols=("sequence_id", "frame")) -> DataFrame:
    """Annotation rows (one per object, track annotation and frame) of the newest document per
    sequence, before boxes (every annotation type still present)."""
    tasks = keep_latest_label(_tasks(docs, schema))
    tasks = tasks.withColumn("ingest_date", ingest_date("modified")).drop("modified")
    tasks = const_cols(tasks, {"labeling_fps": C.LABELING_FPS, "legacy": C.LABEL_LEGACY,
                               "label_source": C.LABEL_SOURCE})
    rows = explode_annotations(explode_objects(tasks))
    return first_label(rows.withColumn("primary_key", label_primary_key(*key_cols)))


def rejected_annotations(rows: DataFrame) -> DataFrame:
    """Annotations whose type is neither rectangle nor polygon (``bbox_union`` drops them)."""
    return rows.where(~F.coalesce(F.col("type").isin(C.ANNOTATION_RECT, C.ANNOTATION_POLYGON), F.lit(False)))


def labels_from_documents(docs: DataFrame, old: DataFrame | None = None, schema=schemas.LABEL_DOCUMENT,
                          key_cols=("sequence_id", "frame"), old_tasks: DataFrame | None = None) -> DataFrame:
    """Annotation rows with uniform boxes (types other than rectangle and polygon are dropped).

    With ``old`` rows and ``old_tasks`` (``label_tasks`` of the documents behind them), versions are decided over old
    and new documents, so the result equals one run over all of them.  Without ``old_tasks`` the stored versions of
    the old rows stand in: old documents without annotations are unknown then.  A document that is among the old ones
    (same ``filepath``) adds nothing.  ``key_cols`` builds ``primary_key`` (add ``object_id`` for a key per object).
    """
    if old is None:
        return bbox_union(annotation_rows(docs, schema, key_cols))
    if old_tasks is None:
        old_tasks = old.groupBy("sequence_id", *_ORDER).agg(F.max("label_version").cast("long").alias("n"))
    docs = skip_done(docs, old_tasks, "filepath")
    rows = bbox_union(annotation_rows(docs, schema, key_cols))
    return keep_newest_documents(append_union(old, rows), old_tasks.unionByName(label_tasks(docs, schema)))


def label_table(labels: DataFrame, ontology: DataFrame) -> DataFrame:
    """Labels with ontology hierarchy and the per-annotation struct."""
    return add_ontology(labels, ontology).withColumn("annotations", annotation_struct())


def sequences_with_labels(sequences: DataFrame, labels: DataFrame) -> DataFrame:
    """Final catalogue: sequences plus label summaries and report columns."""
    return label_join(sequences, labels, "sequence_id")
