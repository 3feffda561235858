"""Clips of crowded slots fan out over their neighbours: what is stored and worked out once a clip."""


from pyspark.sql import functions as F

from seqcat.plans.catalogue import build_catalogue
from seqcat.plans.incremental import catalogue_table, update_catalogue
from seqcat.plans.sequences import enrich, split
from seqcat.sources import stage_read
from seqcat.sources.runs import Runs
from tests.test_incremental import USCG, rows
from tests.tree import write_tree

CROWDED = [(f"b{i % 2}", f"s{i}", "r1", str(5 * (i % 3)), USCG, b"v%d" % i, 2) for i in range(9)]
MORE = [("b3", f"t{i}", "r1", "10", USCG, b"w%d" % i, 2) for i in range(3)]


def test_runs_store_one_row_a_clip_and_tables_fan_out(spark, tmp_path):
    paths = write_tree(str(tmp_path), label_docs={}, sequences=CROWDED)
    args, out = (spark, paths["raw"], paths["labels"], paths["ontology"]), str(tmp_path / "out")
    update_catalogue(*args, out)
    write_tree(str(tmp_path), label_docs={}, sequences=MORE)
    update_catalogue(*args, out)
    built = build_catalogue(*args, str(tmp_path / "built"))
    for table in ("sequences", "catalogue"):
        stored, found = Runs(spark, out).current(table, "batch"), catalogue_table(spark, out, table)
        assert stored.count() == len(CROWDED + MORE) == stored.select("sequence_id").distinct().count()
        want = stage_read(spark, built[table])
        assert rows(found) == rows(want.select(found.columns)) and set(found.columns) == set(want.columns) and found.count() > stored.count()


def test_a_catalogue_of_a_former_version_is_read_and_then_done_anew(spark, tmp_path, monkeypatch):
    from seqcat.plans import incremental

    paths = write_tree(str(tmp_path), label_docs={}, sequences=CROWDED)
    args, out = (spark, paths["raw"], paths["labels"], paths["ontology"]), str(tmp_path / "out")
    with monkeypatch.context() as former:
        former.setattr(incremental, "described", enrich)
        former.setattr(incremental, "_one_row_a_clip", lambda runs, table: True)
        update_catalogue(*args, out)
    old = rows(catalogue_table(spark, out, "catalogue"))
    write_tree(str(tmp_path), label_docs={}, sequences=MORE)
    update_catalogue(*args, out)
    assert catalogue_table(spark, out, "catalogue").count() > len(old)
    assert Runs(spark, out).current("sequences", "batch").count() == len(CROWDED + MORE)


def test_the_split_is_worked_out_before_neighbours_fan_out(spark):
    clips = [(f"s{i}", "b", f"/b/s{i}", "r", 5.0 * (i % 2), 150.0) for i in range(6)]
    df = spark.createDataFrame(clips, "sequence_id string, seq_metadata_batch_path string, seq_metadata_filepath string, src_record_key string, "
                               "time_offset_s double, frame_count double").withColumn("ingest_date", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    out, former = enrich(df, split), split(enrich(df))
    assert rows(out) == rows(former) and set(out.columns) == set(former.columns)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    assert not any("hash(" in line for line in plan[:first])
