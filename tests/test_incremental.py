"""The catalogue updated run by run equals one run over everything, and unchanged batches are left alone."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from seqcat.plans.incremental import TABLES, catalogue_table, update_catalogue
from seqcat.plans.catalogue import build_catalogue
from seqcat.sources import stage_read
from seqcat.sources.files import telemetry_documents, video_files
from tests.tree import LABEL_DOCS, RECT, _label_doc, _obj, write_tree

USCG = "USCG-MIAMI"
# (batch, sequence, record key, offset, source, video, frames)
FIRST = [("b1 +", "s1", "r1", "0", USCG, b"same", 3), ("b1 +", "s2", "r1", "5", USCG, b"two", 3), ("b1 +", "s3", None, "0", USCG, b"three", 2),
         ("b2", "s4", "r2", "0", USCG, b"four", 4), ("b2", "s5", "r2", "5", USCG, b"five", 4), ("b2", "moved", "r2", "10", USCG, b"five", 2),
         ("alone", "s6", "r6", "0", USCG, b"six", 2)]
SECOND = [("b3", "s7", "r1", "10", USCG, b"same", 5), ("b3", "s8", None, "0", USCG, b"eight", 2), ("b3", "moved", "r8", "0", USCG, b"moved", 3),
          ("b4{x}", "s9", "r9", "0", "NOT-ALLOWED", b"nine", 1)]
BOAT = [_obj("o9", "boat", "iri:boat", [RECT])]


def _task(seq, objects):
    return {"id": f"t-{seq}", "name": f"{seq}.mp4", "url": "u", "objectOccurrences": objects}


LATER = {"p3.json": _label_doc("p3", "2023-03-01T00:00:00", [_task("s2", []), _task("s1", [])]),  # newest, without objects
         "p0.json": _label_doc("p0", "2022-01-01T00:00:00", [_task("s4", BOAT), _task("s7", BOAT), _task("s6", BOAT)])}  # late, older


def rows(df):
    cols = sorted(df.columns)
    return sorted(str({c: round(v, 9) if isinstance(v := r[c], float) else v for c in cols}) for r in df.collect())


def tables(spark, out, ontology):
    return {t: catalogue_table(spark, out, t, ontology) for t in TABLES}


def files(out):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{out}/**/*", recursive=True) if os.path.isfile(f) and "SUCCESS" not in f}


@pytest.fixture(scope="module")
def updated(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("grown"))
    out = os.path.join(root, "out")
    paths = write_tree(root, label_docs=LABEL_DOCS, sequences=FIRST)
    args = (spark, paths["raw"], paths["labels"], paths["ontology"])
    reports = [update_catalogue(*args, out)]
    first = files(out)
    reports.append(update_catalogue(*args, out))  # nothing new
    assert files(out) == first
    write_tree(root, label_docs=LATER, sequences=SECOND)
    reports.append(update_catalogue(*args, out))
    return args, out, reports, first


def test_two_runs_equal_one(spark, updated):
    args, out, reports, _ = updated
    assert [r["run"] for r in reports] == [1, 1, 2]
    assert reports[0]["new_batches"] == ["alone", "b1 +", "b2"] and reports[2]["new_batches"] == ["b3", "b4{x}"]
    assert reports[0]["new_documents"] == ["p1.json", "p2.json"] and reports[2]["new_documents"] == ["p0.json", "p3.json"]
    assert reports[0]["rejected_annotations"] == 1 and reports[1]["new_documents"] == []
    whole = out + "-whole"
    update_catalogue(*args, whole)
    a, b = tables(spark, out, args[3]), tables(spark, whole, args[3])
    for t in TABLES:
        assert sorted(a[t].columns) == sorted(b[t].columns), t
        assert rows(a[t]) == rows(b[t]), t
    assert a["catalogue"].count() == 9 and a["labels"].where("sequence_id in ('s1', 's2')").count() == 0  # newest documents are empty


def test_runs_equal_the_full_build(spark, updated):
    args, out, _, _ = updated
    built = build_catalogue(*args, out + "-built")
    for t in TABLES:
        want, got = stage_read(spark, built[t]), catalogue_table(spark, out, t, args[3])
        assert sorted(want.columns) == sorted(got.columns), t
        assert rows(want) == rows(got), t


def test_only_changed_batches_are_written(spark, updated):
    _, out, _, first = updated
    now = files(out)
    assert {f: now[f] for f in first} == first  # what the first run wrote is as it was
    new = [f for f in now if f not in first and f.endswith(".parquet")]
    written = {f.split("batch=")[1].split("/")[0] for f in new if "/sequences/" in f}
    assert written == {"b1%20+", "b2", "b3"} or written == {"b1 +", "b2", "b3"}  # shared record, hash, moved clip; not 'alone'
    catalogue = {f.split("batch=")[1].split("/")[0] for f in new if "/catalogue/" in f}
    assert catalogue - written == {"alone"}  # s6 got a label
    assert not [f for f in new if "/frames_flat/" in f and "batch_path=b3" not in f and "batch_path=b4" not in f]


def test_a_failed_run_is_done_again(spark, updated, tmp_path, monkeypatch):
    from seqcat.plans import incremental
    args, out, _, _ = updated
    again = str(tmp_path / "out")
    monkeypatch.setattr(incremental, "_rework_sequences", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        update_catalogue(*args, again)
    monkeypatch.undo()
    assert update_catalogue(*args, again)["run"] == 1
    assert rows(catalogue_table(spark, again, "catalogue")) == rows(catalogue_table(spark, out, "catalogue"))
    assert rows(catalogue_table(spark, again, "frames")) == rows(catalogue_table(spark, out, "frames"))


def test_full_refresh_and_changed_types(spark, tmp_path):
    paths = write_tree(str(tmp_path), label_docs={}, sequences=FIRST[:2])
    with pytest.raises(FileNotFoundError, match="no run"):
        catalogue_table(spark, str(tmp_path / "out"), "catalogue")
    args = (spark, paths["raw"], paths["labels"], paths["ontology"], str(tmp_path / "out"))
    assert update_catalogue(*args)["new_documents"] == []
    assert catalogue_table(spark, args[4], "catalogue").where("is_labeled").count() == 0
    video = glob.glob(f"{paths['raw']}/b1 +/s1/seq_mp4/*")[0]
    with open(video, "wb") as f:
        f.write(b"another video")
    assert update_catalogue(*args)["run"] == 1  # a batch that is done is skipped
    assert update_catalogue(*args, full_refresh=True)["run"] == 2
    sizes = {r.sequence_id: r.total_filesize_bytes for r in catalogue_table(spark, args[4], "catalogue").collect()}
    assert sizes["s1"] - sizes["s2"] == len(b"another video") - len(b"two")
    write_tree(str(tmp_path), label_docs={}, sequences=SECOND[:1], meta={"seq_nb_frames": 4.5})  # text before, a number now
    assert update_catalogue(*args)["run"] == 3
    whole = str(tmp_path / "whole")
    update_catalogue(*args[:4], whole)
    assert rows(catalogue_table(spark, args[4], "catalogue")) == rows(catalogue_table(spark, whole, "catalogue"))


@pytest.mark.parametrize("inline", [1000, 0])
def test_only_the_first_file_of_a_folder_is_read(spark, tmp_path, monkeypatch, inline):
    from seqcat.sources import files as source
    paths = write_tree(str(tmp_path), sequences=FIRST[:2])
    for extra in ("a-first.mp4", "zz.mp4"):
        (tmp_path / "raw/b1 +/s1/seq_mp4" / extra).write_bytes(extra.encode())
    (tmp_path / "raw/b1 +/s2/mapp_metadata/zz.json").write_text("never read")
    (tmp_path / "raw/b1 +/s2/deeper/mapp_metadata").mkdir(parents=True)
    (tmp_path / "raw/b1 +/s2/deeper/mapp_metadata/x.json").write_text("another depth")
    monkeypatch.setattr(source, "SURPLUS_INLINE_MAX", inline)
    videos = {r.sequence_id: r.md5_hash for r in video_files(spark, paths["raw"]).collect()}
    assert set(videos) == {"a-first", "s2"} and None not in videos.values()
    docs = telemetry_documents(spark, paths["raw"])
    assert {r.sequence_id for r in docs.collect()} == {"s1", "s2"}
    plan = docs._jdf.queryExecution().executedPlan().toString()
    if inline:  # no shuffle, so the text stays where it is read
        assert "Exchange" not in plan and "Aggregate" not in plan
    assert docs.where(F.col("src_json").contains("never")).count() == 0


def test_customers_with_any_order_are_done(spark, tmp_path):
    from seqcat.plans.table_queries import QUERIES
    names = "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"
    spark.createDataFrame([(k, f"c{k}", 1, 0.5, "m") for k in range(1, 6)], names).write.parquet(str(tmp_path / "customer.parquet"))
    orders = [(1, 1, "F"), (2, 2, "O"), (3, 3, "P"), (4, 4, None), (5, None, "P")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    assert [r.file_name for r in QUERIES["incremental_labels"](spark, str(tmp_path)).collect()] == ["c5.json"]


def test_raw_files_are_listed_on_executors(spark, tmp_path):
    """No file of the raw folder is named in a plan on the driver; texts, sizes and times are those of Spark's own reader."""
    import gzip
    files = {"x.json": b"[1]", "y.json": b"", "z.json.gz": gzip.compress(b"[2]"), "w.json": b"caf\xe9 \xff"}
    for name, content in files.items():
        folder = tmp_path / "raw/b 1" / name.split(".")[0] / "mapp_metadata"
        folder.mkdir(parents=True)
        for extra in ("_hidden.json", ".a.json"):
            (folder / extra).write_bytes(b"never")
        (folder / name).write_bytes(content)
    (tmp_path / "raw/b 1/file").write_text("no clip")
    (tmp_path / "raw/b 1/odd").mkdir()
    (tmp_path / "raw/b 1/odd/mapp_metadata").write_text("no folder")
    docs = telemetry_documents(spark, str(tmp_path / "raw"))
    assert docs.inputFiles() and not any("/raw/" in f for f in docs.inputFiles())
    own = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(str(tmp_path / "raw")).select(
        F.regexp_extract("_metadata.file_path", "([^/]+)$", 1), "_metadata.file_modification_time", "_metadata.file_size",
        F.hex(F.col("value").cast("binary"))).where(F.col("_metadata.file_path").contains("/mapp_metadata/")).collect()
    got = docs.select(F.regexp_extract("filepath", "([^/]+)$", 1), "modified", "filesize_bytes", F.hex(F.col("src_json").cast("binary"))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, own)) and len(got) == 3
    (tmp_path / "raw/b 1/x/seq_mp4").mkdir()
    (tmp_path / "raw/b 1/x/seq_mp4/x.mp4").write_bytes(b"")
    own = spark.read.format("binaryFile").load(str(tmp_path / "raw/*/*/seq_mp4/*")).select("path", "modificationTime", "length", F.md5("content")).collect()
    got = video_files(spark, str(tmp_path / "raw")).select("filepath", "modified", "filesize_bytes", "md5_hash").collect()
    assert list(map(tuple, got)) == list(map(tuple, own))


def test_rows_are_deduplicated_before_neighbours_fan_out(spark):
    """Repeated rows and candidates: the rows are distinct, and none of the joined rows is aggregated, shuffled or sorted."""
    from seqcat.operators import neighbours
    from seqcat.plans.sequences import enrich
    rows = [(f"s{i}", "b", f"/b/s{i}", "r", 5.0 * (i % 2), 150.0) for i in range(6)] * 2
    df = spark.createDataFrame(rows, "sequence_id string, seq_metadata_batch_path string, seq_metadata_filepath string, src_record_key string, "
                               "time_offset_s double, frame_count double")
    out = enrich(df)
    got = [(r.sequence_id, r.next_sequence_id, r.prev_sequence_id) for r in out.collect()]
    want = neighbours(df.distinct(), length=F.lit(5)).collect()
    assert len(got) == len(set(got)) == 18 and set(got) == {(r.sequence_id, r.next_sequence_id, r.prev_sequence_id) for r in want}
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    assert not any(x in line for line in plan[:first] for x in ("Aggregate", "Repartition", "Sort"))
