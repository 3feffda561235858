"""File-stream ingest and keep-latest over an incremental feed.

A file stream with a checkpoint replaces "skip folders already seen": every
file is processed exactly once, a rerun with no new files adds nothing, and a
lost executor only re-runs its tasks (the sink commit is transactional).
"""

from pyspark.sql import DataFrame, SparkSession

from seqcat.operators.windows import latest_per_key, latest_row_agg
from seqcat.sources.folders import exists, remove, subfolders


def stream_ingest(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, *, fmt: str = "parquet",
                  transform=None, options: dict | None = None) -> None:
    """Process every file under ``source`` not yet seen and append the rows to the Parquet ``sink``.

    ``fmt`` is any file source (``parquet``, ``json``, ``text``, ``binaryFile``);
    ``transform`` is an optional ``DataFrame -> DataFrame`` applied per micro-batch
    (row-wise operators only).  Runs with ``availableNow`` and returns when done.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source)
    if transform is not None:
        stream = transform(stream)
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()


def _epoch_path(sink: str, epoch_id: int, kind: str = "epoch") -> str:
    return f"{sink.rstrip('/')}/{kind}={epoch_id}"


def _epochs(spark: SparkSession, sink: str) -> tuple[int | None, list[int]]:
    """The newest base of a sink (None without one), and the epochs written after it."""
    numbers = {"base": [], "epoch": []}
    for name in subfolders(spark, sink) if exists(spark, sink) else []:
        kind, _, n = name.partition("=")
        if kind in numbers and exists(spark, f"{sink.rstrip('/')}/{name}/_SUCCESS"):
            numbers[kind].append(int(n))
    base = max(numbers["base"], default=None)
    return base, sorted(n for n in numbers["epoch"] if base is None or n > base)


def read_epochs(spark: SparkSession, sink: str, schema=None) -> DataFrame:
    """All rows of a sink that was written epoch by epoch (and of its base); whole epochs only."""
    base, epochs = _epochs(spark, sink)
    paths = ([] if base is None else [_epoch_path(sink, base, "base")]) + [_epoch_path(sink, n) for n in epochs]
    out = None
    for path in paths:  # each folder by itself: a data column may be called epoch
        part = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no epoch has been written to {sink}")
    return out


def stream_ingest_rejects(spark: SparkSession, source: str, schema, sink: str, rejects: str, checkpoint: str, *, tag,
                          fmt: str = "parquet", options: dict | None = None) -> None:
    """``stream_ingest`` for input that may be bad: every micro-batch goes to two sinks.

    ``tag`` is a row-wise ``DataFrame -> DataFrame`` that adds a column ``reason``: rows without a reason go to ``sink`` (without that
    column), the others to ``rejects``.  Both are written to a folder per epoch and overwritten on replay, so each row is
    in exactly one of them once, also when a batch is done again after a failure between the two writes.  Read them by
    ``read_epochs``.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = tag(reader.load(source))

    def write_both(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()  # parsed once for both sinks
        try:
            batch.where("reason is null").drop("reason").write.mode("overwrite").parquet(_epoch_path(sink, epoch_id))
            batch.where("reason is not null").write.mode("overwrite").parquet(_epoch_path(rejects, epoch_id))
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(write_both).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, sink: str, key, order_cols) -> DataFrame:
    """Current state of a ``stream_latest`` sink: newest row per key over its base and the epochs after it."""
    return latest_per_key(read_epochs(spark, sink), key, order_cols)


def compact_latest(spark: SparkSession, sink: str, out: str, key, order_cols) -> None:
    """Fold every committed epoch of a ``stream_latest`` sink into one Parquet table at ``out``
    (one row per key), so readers no longer resolve epochs."""
    read_latest(spark, sink, key, order_cols).write.mode("overwrite").parquet(out)


def fold_latest(spark: SparkSession, sink: str, key, order_cols) -> None:
    """Fold the epochs of a ``stream_latest`` sink into a new base inside the sink (one row per key); later epochs build on it.

    The base counts from the moment its write is complete; only then are the epochs and the base that it holds removed, so
    a fold that dies loses nothing and is simply done again.  Run it between two ``stream_latest`` runs.
    """
    base, epochs = _epochs(spark, sink)
    if not epochs:
        return
    read_latest(spark, sink, key, order_cols).write.mode("overwrite").parquet(_epoch_path(sink, epochs[-1], "base"))
    for kind, n in [("epoch", n) for n in epochs] + ([] if base is None else [("base", base)]):
        remove(spark, _epoch_path(sink, n, kind))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _own_session(spark: SparkSession, settings: dict) -> SparkSession:
    """A session with the settings of ``spark`` and some more, which hold for its queries only."""
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **settings}.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def stream_latest(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, *, key, order_cols,
                  fmt: str = "parquet", state_partitions: int | None = None, rocksdb: bool = True) -> None:
    """Keep the newest row per key over an incremental feed.

    A streaming ``groupBy(key).agg(max_by(row, order))`` in update mode: the
    state store (checkpointed with the query) holds one bounded buffer per key,
    so no micro-batch re-reads stored rows.  Each epoch writes the rows of the
    keys it changed to ``<sink>/epoch=<id>`` (overwritten on replay, so a retried
    batch is idempotent); ``read_latest`` resolves the current state, ``fold_latest`` folds the epochs.

    The state is kept in RocksDB with changelog checkpoints, on the executors' disks: it may outgrow their memory, and an epoch uploads
    its changes only (``rocksdb=False``: Spark's default store, in memory).  ``state_partitions`` sets the number of state-store
    partitions when the checkpoint is created (Spark keeps that number for the life of the checkpoint); by default the
    session's ``spark.sql.shuffle.partitions``.  These settings hold for this query, not for the caller's session.
    """
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"} if rocksdb else {}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    stream = _own_session(spark, settings).readStream.format(fmt).schema(schema).load(source)
    keys, agg = latest_row_agg(stream, key, order_cols)
    latest = stream.groupBy(*keys).agg(agg).select(*keys, "_m.*").select(*stream.columns)

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_epoch_path(sink, epoch_id))

    q = (latest.writeStream.outputMode("update").foreachBatch(write_epoch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
