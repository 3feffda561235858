"""Streaming ingest / keep-latest properties and output layout."""

from pyspark.sql import functions as F

from seqcat.operators import cluster_by_key, latest_per_key, sort_catalogue
from seqcat.session import scratch_dir
from seqcat.streaming import compact_latest, read_latest, stream_ingest, stream_latest
from tests.conftest import SF_SMALL


def test_stream_ingest_rerun_adds_nothing(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("t-src", "t-sink", "t-ckpt"))
    half = F.col("event_id") % 2 == 0
    ev.where(half).write.parquet(src)
    stream_ingest(spark, src, ev.schema, sink, ckpt)
    assert spark.read.parquet(sink).count() == ev.where(half).count()
    ev.where(~half).write.mode("append").parquet(src)
    stream_ingest(spark, src, ev.schema, sink, ckpt)
    stream_ingest(spark, src, ev.schema, sink, ckpt)
    got = spark.read.parquet(sink)
    assert got.count() == ev.count() and got.exceptAll(ev).count() == 0


def test_stream_latest_equals_batch_and_is_idempotent(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("l-src", "l-sink", "l-ckpt"))
    for i in range(3):
        ev.where(F.pmod(F.col("event_id"), F.lit(3)) == i).write.mode("append").parquet(src)
        stream_latest(spark, src, ev.schema, sink, ckpt, key="user_id", order_cols=["ts", "event_id"])
    stream_latest(spark, src, ev.schema, sink, ckpt, key="user_id", order_cols=["ts", "event_id"])
    got = read_latest(spark, sink, "user_id", ["ts", "event_id"])
    want = latest_per_key(ev, "user_id", ["ts", "event_id"])
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    compacted = scratch_dir(spark, "l-compact")
    compact_latest(spark, sink, compacted, "user_id", ["ts", "event_id"])
    assert spark.read.parquet(compacted).exceptAll(want).count() == 0


def test_folded_epochs_and_a_column_called_epoch(spark):
    from seqcat.sources.folders import subfolders
    from seqcat.streaming import fold_latest
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("epoch", F.col("event_id") % 4)
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("f-src", "f-sink", "f-ckpt"))
    own = spark.conf.get("spark.sql.shuffle.partitions")
    for i in range(3):
        ev.where(F.pmod(F.col("event_id"), F.lit(3)) == i).write.mode("append").parquet(src)
        stream_latest(spark, src, ev.schema, sink, ckpt, key="user_id", order_cols=["ts", "event_id"], state_partitions=3)
        if i:
            fold_latest(spark, sink, "user_id", ["ts", "event_id"])
            assert len(subfolders(spark, sink)) == 1 and subfolders(spark, sink)[0].startswith("base=")
    assert spark.conf.get("spark.sql.shuffle.partitions") == own
    got, want = read_latest(spark, sink, "user_id", ["ts", "event_id"]), latest_per_key(ev, "user_id", ["ts", "event_id"])
    assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).count() == 0


def test_rejects_are_written_once_when_a_batch_is_done_again(spark, monkeypatch):
    import pytest
    from pyspark.errors import StreamingQueryException

    from seqcat.operators.jsonx import tagged_frames
    from seqcat.streaming import ingest, read_epochs, stream_ingest_rejects
    src, sink, bad, ckpt = (scratch_dir(spark, n) for n in ("r-src", "r-sink", "r-bad", "r-ckpt"))
    docs = spark.createDataFrame([('[{"a":1.10}, null, 5]',), ("oops",), ('{"a":2}',), ("[]",), (None,)], "src_json string")
    docs.write.parquet(src)
    tag = lambda df: tagged_frames(df).select("reason", F.to_json("frame").alias("frame"), "rejected")
    path, calls = ingest._epoch_path, []

    def fails_at_the_second_sink(where, *rest):
        calls.append(where)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return path(where, *rest)
    monkeypatch.setattr(ingest, "_epoch_path", fails_at_the_second_sink)
    with pytest.raises(StreamingQueryException):
        stream_ingest_rejects(spark, src, docs.schema, sink, bad, ckpt, tag=tag)
    monkeypatch.setattr(ingest, "_epoch_path", path)
    for _ in range(2):
        stream_ingest_rejects(spark, src, docs.schema, sink, bad, ckpt, tag=tag)
    assert sorted(r.frame for r in read_epochs(spark, sink).collect()) == ['{"a":1.1}', '{"a":2}']
    assert sorted((r.reason, r.rejected or "") for r in read_epochs(spark, bad).collect()) == [
        ("element is no object", "5"), ("element is no object", "null"), ("no JSON", ""), ("no JSON", "oops")]


def test_partitioned_writes_are_balanced(spark, tmp_path):
    from seqcat.sources import stage_write
    rows = spark.range(200_000).select(F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.concat(F.lit("b"), F.col("id") % 7)).alias("batch"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("x"), "id").repartition(24)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        stage_write(rows, str(tmp_path / "t"), partition_by="batch", sort_by=["id"])
    finally:
        spark.conf.set(size, old)
    files = {f.name: len(list(f.glob("*.parquet"))) for f in (tmp_path / "t").glob("batch=*")}
    assert len(files) == 8 and max(n for b, n in files.items() if b != "batch=hot") <= 2  # not one a task
    assert 3 <= files["batch=hot"] <= 16  # the hot batch is split
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_cluster_by_key_layout(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    parts = cluster_by_key(o, "o_custkey", ("o_custkey", "o_orderdate")) \
        .select(F.spark_partition_id().alias("p"), "o_custkey", "o_orderdate").collect()
    seq = [(r.p, r.o_custkey, r.o_orderdate) for r in parts]
    assert seq == sorted(seq)  # partitions hold consecutive key ranges, sorted inside
    assert len(parts) == o.count()


def test_sort_catalogue_order(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    got = [(r.o_orderdate, r.o_orderkey) for r in sort_catalogue(o, [("o_orderdate", False), ("o_orderkey", True)])
           .collect()]
    assert got == sorted(got, key=lambda t: (-t[0].timestamp(), t[1]))


def test_text_file_stream_whole_documents(spark, tmp_path):
    import json

    from pyspark.sql import types as T

    from seqcat.operators import parse_json
    src = tmp_path / "docs"
    src.mkdir()
    for i in range(3):
        (src / f"d{i}.json").write_text(json.dumps({"k": i, "name": f"n{i}"}, indent=2))
    sink, ckpt = scratch_dir(spark, "txt-sink"), scratch_dir(spark, "txt-ckpt")
    schema = T.StructType([T.StructField("value", T.StringType())])
    for _ in range(2):  # second run: nothing new
        stream_ingest(spark, str(src), schema, sink, ckpt, fmt="text", options={"wholetext": "true"})
    docs = parse_json(spark.read.parquet(sink), "value", "k BIGINT, name STRING").select("value.*")
    assert sorted(tuple(r) for r in docs.collect()) == [(0, "n0"), (1, "n1"), (2, "n2")]
