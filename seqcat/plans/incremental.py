"""The catalogue kept up to date run by run: only new batches and new label documents are read.

A batch folder or label file that a committed run has taken in is skipped (``full_refresh=True`` starts over).  Heavy inputs are
touched once: video bytes, telemetry and label documents of new batches only.  What a new row changes elsewhere is
found by keys and only the batches concerned are worked out and written again:

* a clip's description, files, frames or labels in another batch: the same ``sequence_id``;
* duplicate facts: the same content hash, of the new rows and of those they supersede;
* neighbours and dimensions filled from siblings: the same recording; and since a neighbour's length is that of its
  batch, every recording with a clip in a batch whose clips changed.

Averages over all frames change with every run, so they are kept as sums per run and attached when a table is read; the
stored rows of unchanged batches stay as they are.  Neighbours are attached then, too: n next and m previous clips make n * m rows
of a clip, which are stored nowhere.  ``catalogue_table`` reads a table; its rows equal those
of one run over everything.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat import schemas
from seqcat.operators._join import null_safe_join
from seqcat.operators.boxes import bbox_union
from seqcat.operators.incremental import skip_done
from seqcat.operators.jsonx import malformed_documents
from seqcat.operators.rollup import starts_and_ends
from seqcat.plans.annotations import (
    annotation_rows,
    keep_newest_documents,
    label_table,
    label_tasks,
    rejected_annotations,
    sequences_with_labels,
)
from seqcat.plans.sequences import described, merge_catalogue, sequence_table, split, with_neighbours
from seqcat.plans.telemetry import flat_frames, sequences_from_frames
from seqcat.session import stored
from seqcat.sources import (
    dim_read,
    label_documents,
    label_listing,
    sequence_documents,
    still_files,
    telemetry_documents,
    video_files,
)
from seqcat.sources.folders import subfolders
from seqcat.sources.runs import Runs, SchemaChanged

TABLES = ("frames", "telemetry", "sequences", "labels", "catalogue")
_ID = "sequence_id"
_AVERAGE = "global_average_"


def _names(spark: SparkSession, names, column: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{column} string")


def _new_names(listing: DataFrame, runs: Runs, table: str, column: str) -> list[str]:
    """Names of the listing that no committed run has taken in: one short string per new folder or file."""
    new = skip_done(listing, runs.rows(table), column) if runs.has(table) else listing
    return sorted(r[0] for r in new.select(column).distinct().collect())


def _of(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    return null_safe_join(df, keys.select(column).distinct(), [column], "left_semi")


def _take_in_batches(runs: Runs, spark: SparkSession, root: str, batches: list[str], frame_schema) -> int:
    """Append the new batches' files, descriptions and frames; the number of malformed telemetry documents."""
    if not batches and runs.has("videos"):
        return 0
    only = lambda df: df if batches else df.limit(0)  # noqa: E731  a first run without batches makes empty tables
    where = batches or None
    runs.append("videos", only(video_files(spark, root, where)))
    runs.append("stills", only(still_files(spark, root, where)))
    runs.append("descriptions", only(sequence_documents(spark, root, where)))
    telemetry = stored(only(telemetry_documents(spark, root, where)), "telemetry-documents")
    runs.append("frames_flat", flat_frames(telemetry, frame_schema), partition_by="batch_path")
    frames = runs.new_rows("frames_flat")
    held = [c for c in C.GLOBAL_AVERAGE_COLUMNS if c in frames.columns]
    sums = [x for c in held for x in (F.sum(F.col(c).cast("double")).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))]
    runs.append("frame_sums", frames.agg(F.count(F.lit(1)).alias("frames"), *sums))
    runs.append("frame_batches", frames.select(_ID, "batch_path").distinct())
    return malformed_documents(telemetry, array=True).count()


def _roll_up_frames(runs: Runs) -> DataFrame:
    """Telemetry of the sequences with new frames, over all their frames; returns these sequences.  Only the batch folders that
    hold frames of them are read."""
    touched = stored(runs.new_rows("frame_batches").select(_ID).distinct(), "sequences-with-new-frames")
    held = runs.rows("frame_batches")
    folders = stored(_of(held, touched, _ID).select("batch_path").distinct(), "batches-with-their-frames")
    frames = runs.rows("frames_flat").join(folders, "batch_path", "left_semi")
    frames = starts_and_ends(stored(_of(frames, touched, _ID), "their-frames"), _ID, "sequence_frame", C.START_END_COLUMNS, last=C.LAST_FRAME)
    runs.replace("telemetry", _ID, touched, sequences_from_frames(frames))
    return touched


def _take_in_labels(runs: Runs, spark: SparkSession, folder: str, names: list[str]) -> tuple[DataFrame | None, int]:
    """Append the new documents' annotations and tasks, and store the labels of the sequences they name."""
    if not names and runs.has("label_rows"):
        return None, 0
    docs = label_documents(spark, folder, names) if names else label_documents(spark, folder).limit(0)
    docs = stored(docs, "label-documents")
    runs.append("annotations", annotation_rows(docs))
    runs.append("label_tasks", label_tasks(docs))
    touched = stored(runs.new_rows("label_tasks").select(_ID).distinct(), "sequences-with-new-labels")
    rows = keep_newest_documents(_of(runs.rows("annotations"), touched, _ID), _of(runs.rows("label_tasks"), touched, _ID))
    runs.replace("label_rows", _ID, touched, rows)
    return touched, malformed_documents(docs).count()


def _descriptions(runs: Runs, seq_schema) -> DataFrame:
    return sequence_table(runs.rows("descriptions"), seq_schema)


def _touched_batches(runs: Runs, seq: DataFrame, touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(batches to write, batches to work them out from), each a stored table (batch_path)."""
    spark = seq.sparkSession
    keyed = stored(seq.select(_ID, "batch_path", F.col("src_record_key") if "src_record_key" in seq.columns
                             else F.lit(None).cast("string").alias("src_record_key")).distinct(), "clips")
    own = stored(_of(keyed, touched, _ID), "touched-clips")  # new descriptions and those they supersede
    videos = runs.rows("videos").where(F.col("md5_hash").isNotNull()).select(_ID, "md5_hash")
    copies = _of(videos, _of(videos, touched, _ID), "md5_hash").select(_ID)
    in_batch = _of(keyed, own, "batch_path").where(F.col("src_record_key").isNotNull()).select("src_record_key")
    no_record = own.where(F.col("src_record_key").isNull()).select("src_record_key")  # one group when dimensions are filled
    records = in_batch.union(no_record)
    write = (own.select("batch_path").union(_of(keyed, copies, _ID).select("batch_path"))
             .union(_of(keyed, records, "src_record_key").select("batch_path")).distinct())
    write = stored(write, "batches-to-write")
    near = _of(keyed, write, "batch_path").where(F.col("src_record_key").isNotNull()).select("src_record_key")
    read = write.union(_of(keyed, near, "src_record_key").select("batch_path")).distinct()
    return write, stored(read, "batches-to-read")


def _rework_sequences(runs: Runs, seq: DataFrame, touched: DataFrame) -> DataFrame:
    """Write the sequences of every batch that the touched clips change; returns those batches."""
    write, read = _touched_batches(runs, seq, touched)
    merged = merge_catalogue(seq, runs.current("telemetry", _ID), runs.rows("stills"), runs.rows("videos"))
    merged = stored(_of(merged, read.withColumnRenamed("batch_path", "seq_metadata_batch_path"), "seq_metadata_batch_path"), "merged")
    batches = write.withColumnRenamed("batch_path", "batch")
    rows = _of(split(described(merged)), batches, "batch")
    runs.replace("sequences", "batch", batches, rows, partition_by="batch", sort_by=("src_record_key", "time_offset_s"))
    return batches


def update_catalogue(spark: SparkSession, raw_root: str, label_folder: str, ontology_csv: str, out_root: str, *,
                     full_refresh: bool = False, seq_schema=None, frame_schema=None) -> dict:
    """Take new batches and label documents into the catalogue under ``out_root``.

    Returns ``run`` (the last committed run), ``new_batches``, ``new_documents``, ``rejected_annotations`` and
    ``malformed_documents`` (both of the new documents).  Without anything new no file is written and the run stays.
    If a field has another type than in the stored runs, the run is done over everything instead.

    The ontology is read when labels are: a changed ontology file holds for the labels and catalogue rows written from then on.
    """
    runs = Runs(spark, out_root, full_refresh=full_refresh)
    if runs.has("sequences") and not _one_row_a_clip(runs, "sequences"):  # of a former version, with neighbours
        runs = Runs(spark, out_root, full_refresh=True)
    batches = _new_names(_names(spark, subfolders(spark, raw_root), "batch_path"), runs, "batches", "batch_path")
    names = _new_names(label_listing(spark, label_folder), runs, "documents", "file_name")
    report = {"run": runs.committed, "new_batches": batches, "new_documents": names, "rejected_annotations": 0, "malformed_documents": 0}
    if not batches and not names:
        return report
    try:
        return report | _update(spark, runs, raw_root, label_folder, ontology_csv, batches, names, seq_schema, frame_schema)
    except SchemaChanged:
        if full_refresh or runs.committed < runs.base:
            raise
        return update_catalogue(spark, raw_root, label_folder, ontology_csv, out_root, full_refresh=True, seq_schema=seq_schema,
                                frame_schema=frame_schema)


def _update(spark, runs: Runs, raw_root, label_folder, ontology_csv, batches, names, seq_schema, frame_schema) -> dict:
    runs.start()
    runs.append("batches", _names(spark, batches, "batch_path"))
    runs.append("documents", _names(spark, names, "file_name"))
    malformed = _take_in_batches(runs, spark, raw_root, batches, frame_schema)
    labelled, bad_labels = _take_in_labels(runs, spark, label_folder, names)
    rewritten = None
    if batches or not runs.has("sequences"):
        with_frames = _roll_up_frames(runs)
        seq = _descriptions(runs, seq_schema)
        touched = with_frames
        for table in ("videos", "stills", "descriptions"):
            touched = touched.union(runs.new_rows(table).select(_ID))
        rewritten = _rework_sequences(runs, seq, touched.distinct())
    sequences = runs.current("sequences", "batch")
    if labelled is not None:
        named = _of(sequences.select(_ID, "batch"), labelled, _ID).select("batch")
        rewritten = named if rewritten is None else rewritten.union(named)
    rewritten = stored(rewritten.distinct(), "catalogue-batches")
    rows = _of(sequences, rewritten, "batch")
    labels = _labels(spark, runs, ontology_csv)
    runs.replace("catalogue", "batch", rewritten, sequences_with_labels(rows, _of(labels, rows, _ID)), partition_by="batch")
    rejected = rejected_annotations(runs.new_rows("annotations")).count() if names else 0
    runs.commit()
    return {"run": runs.run, "rejected_annotations": rejected, "malformed_documents": malformed + bad_labels}


def _one_row_a_clip(runs: Runs, table: str) -> bool:
    return "max_frame_count" in runs.schemas[table].fieldNames()


def _fanned_out(runs: Runs, df: DataFrame) -> DataFrame:
    """The rows of a table with their neighbours, dealt to all tasks before they fan out."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    clips = runs.current("sequences", "batch").select(_ID, "src_record_key", "time_offset_s", "max_frame_count")
    return with_neighbours(df.repartition(tasks, _ID), clips)


def _labels(spark: SparkSession, runs: Runs, ontology_csv: str) -> DataFrame:
    return label_table(bbox_union(runs.current("label_rows", _ID)), dim_read(spark, ontology_csv, schemas.ONTOLOGY))


def _averages(runs: Runs) -> dict:
    """The averages over all frames of all runs, from one row of sums a run."""
    sums = runs.rows("frame_sums")
    held = [c for c in C.GLOBAL_AVERAGE_COLUMNS if f"{c}_sum" in sums.columns]
    row = sums.agg(*[(F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0))).alias(c) for c in held]).first() if held else {}
    return {_AVERAGE + c: row[c] for c in held}


def catalogue_table(spark: SparkSession, out_root: str, table: str, ontology_csv: str | None = None) -> DataFrame:
    """A table of the updated catalogue: one of ``TABLES`` (``labels`` needs the ontology file)."""
    runs = Runs(spark, out_root)
    if not runs.committed:
        raise FileNotFoundError(f"no run has been committed under {out_root}")
    if table not in TABLES:
        raise ValueError(f"table is one of {TABLES}, not {table!r}")
    if table == "labels":
        return _labels(spark, runs, ontology_csv)
    if table == "frames":
        frames = runs.rows("frames_flat").withColumns({k: F.lit(v).cast("double") for k, v in _averages(runs).items()})
        return starts_and_ends(frames, _ID, "sequence_frame", C.START_END_COLUMNS, last=C.LAST_FRAME)
    df = runs.current(table, _ID if table == "telemetry" else "batch")
    # a sequence with telemetry has a quality; the roll-up leaves out zeros
    known = F.col("metadata_quality").isNotNull()
    df = df.withColumns({k: F.when(known, F.lit(None if v == 0 else v).cast("double")) for k, v in _averages(runs).items()})
    return _fanned_out(runs, df) if table != "telemetry" and _one_row_a_clip(runs, table) else df
