"""Plans A, B, C end to end on a generated folder tree; sources; incremental labels."""

import json
import os

import pytest
from pyspark.sql import functions as F

from seqcat.plans.annotations import labels_from_documents
from seqcat.plans.catalogue import build_catalogue
from seqcat.sources import label_documents, still_files, video_files
from seqcat.sources.tables import stage_read
from tests.tree import write_tree


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tree"))
    paths = write_tree(root)
    out = build_catalogue(spark, paths["raw"], paths["labels"], paths["ontology"], os.path.join(root, "out"))
    assert out.pop("rejected_annotations") == 1  # the one annotation of an unknown type
    assert out.pop("malformed_documents") == 0
    return paths, {k: stage_read(spark, v) for k, v in out.items()}


def test_sources(spark, built):
    paths, _ = built
    v = {r.sequence_id: r for r in video_files(spark, paths["raw"]).collect()}
    assert set(v) == {"s1", "s2", "s3", "s4", "s5", "s6"}
    assert v["s1"].md5_hash == v["s2"].md5_hash and v["s1"].filesize_bytes == len(b"same-video")
    assert v["s4"].batch_path.endswith("EDGE_20220920")
    assert "md5_hash" not in still_files(spark, paths["raw"]).columns


def test_frames_and_telemetry(built):
    _, t = built
    frames = t["frames"]
    assert frames.count() == 24
    r = frames.where("sequence_id = 's3' AND sequence_frame = 2").first()
    assert r.slant_range is None  # NaN -> null
    assert r.start_altitude_ft == 1000.0 and r.end_altitude_ft is None  # last frame 150 absent
    tel = {r.sequence_id: r for r in t["telemetry"].collect()}
    assert tel["s1"].frame_count == 4 and tel["s1"].sensor_band == "EO"
    assert tel["s1"].image_source_sensor == "EO"  # sentinel blanked, blanks ignored by the mode
    assert tel["s1"].height_pix == 720 and tel["s1"].look_angle == "60-75"
    assert tel["s1"].altitude_ft == 3000.0  # upper median of 1000..4000
    assert 0 <= tel["s1"].metadata_quality <= 1


def test_sequences(built):
    _, t = built
    seqs = {r.sequence_id: r for r in t["sequences"].collect()}
    assert set(seqs) == {"s1", "s2", "s3", "s4", "s5"}  # s6's data source is not allowed
    s1, s2 = seqs["s1"], seqs["s2"]
    assert s1.mission_type == "Coastguard-CDAO" and s1.loe == "FMV" and s1.is_maritime
    assert seqs["s4"].mission_type == "Fixed Maritime Horizontal" and seqs["s4"].loe == "HMI"
    assert s1.next_sequence_id == "s2" and s2.prev_sequence_id == "s1" and s1.prev_sequence_id is None
    assert s1.potential_dupe_count == 1 and s1.first_potential_dupe == "s2"
    assert s2.width == 1280  # filled from the same recording
    assert s1.total_filesize_bytes > 0 and s1.fps == 30.0 and s1.frame_count == 150.0
    assert seqs["s3"].split_key.startswith("Batch:")
    assert s1.split == s2.split  # same recording, same split
    assert s1.extra_field is None and seqs["s5"].extra_field == "only here"


def test_labels(built):
    _, t = built
    labels = t["labels"]
    s1 = labels.where("sequence_id = 's1'").collect()
    assert {r.download_date for r in s1} == {"2023-02-01T00:00:00"}  # only the newest document
    assert sorted((r.x, r.y, r.width, r.height) for r in s1) == [(1.0, 2.0, 2.0, 3.0), (10.0, 10.0, 0.0, 0.0)]
    assert all(r.label_version == 2 for r in s1)
    s4 = labels.where("sequence_id = 's4'").first()
    assert (s4.x, s4.y, s4.width, s4.height) == (576.0, 250.0, 16.0, 6.0) and s4.category_hierarchy is None
    assert labels.where("sequence_id = 's2'").count() == 0  # no objects


def test_final_catalogue(built):
    _, t = built
    final = {r.sequence_id: r for r in t["catalogue"].collect()}
    assert final["s1"].is_labeled and final["s1"].labeled_objects == 2 and final["s1"].categories == ["boat", "person"]
    assert not final["s3"].is_labeled and final["s3"].labeled_objects is None
    seqs = {r.sequence_id: r for r in t["sequences"].collect()}
    assert final["s1"].total_filesize_bytes == seqs["s1"].total_filesize_bytes + final["s1"].label_filesize_bytes \
        if "label_filesize_bytes" in t["catalogue"].columns else final["s1"].total_filesize_bytes > \
        seqs["s1"].total_filesize_bytes
    assert final["s3"].total_filesize_bytes == seqs["s3"].total_filesize_bytes  # unlabelled: + 0


def test_incremental_labels_equal_full(spark, built, tmp_path):
    paths, _ = built
    docs = label_documents(spark, paths["labels"])
    full = labels_from_documents(docs)
    first = labels_from_documents(docs.where(F.col("file_name") == "p1.json"))
    incr = labels_from_documents(docs.where(F.col("file_name") == "p2.json"), old=first)
    cols = ["primary_key", "sequence_id", "x", "y", "width", "height", "download_date", "label_version"]
    assert sorted(full.select(cols).collect()) == sorted(incr.select(cols).collect())


def test_streamed_md5_equals_content_md5(spark, built):
    paths, _ = built
    from seqcat.sources.files import file_catalogue
    pattern = f"{paths['raw']}/*/*/seq_mp4/*"
    a = {r.sequence_id: r.md5_hash for r in file_catalogue(spark, pattern, with_md5=True).collect()}
    b = {r.sequence_id: r.md5_hash for r in file_catalogue(spark, pattern, with_md5=True, content_max_bytes=8)
         .collect()}
    assert a == b and len(a) == 6 and None not in a.values()


NAMES = ["clip+1 a", "c%20d", "e#f", "plain"]


def test_unusual_names_are_the_same_in_every_source(spark, tmp_path):
    """Space, plus, percent and hash in batch, clip and label file names."""
    from seqcat.operators.incremental import skip_done_files
    from seqcat.sources import sequence_documents, telemetry_documents
    from seqcat.sources.files import file_catalogue
    for n in NAMES:
        for sub, ext, text in (("", "json", "{}"), ("seq_mp4/", "mp4", n * 9), ("seq_zip/", "zip", n), ("mapp_metadata/", "json", "[]")):
            path = tmp_path / "raw" / f"b {n}" / n / f"{sub}{n}.{ext}"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
        (tmp_path / "labels").mkdir(exist_ok=True)
        (tmp_path / "labels" / f"{n}.json").write_text("{}")
    raw = str(tmp_path / "raw")
    for read in (video_files, still_files, telemetry_documents, sequence_documents):
        rows = read(spark, raw).collect()
        assert {(r.sequence_id, r.batch_path) for r in rows} == {(n, f"b {n}") for n in NAMES}, read
        assert all(r.filepath.startswith("file:/") and not r.filepath.startswith("file://") for r in rows)
    pattern = f"{raw}/*/*/seq_mp4/*"
    a, b = ({(r.filepath, r.md5_hash) for r in file_catalogue(spark, pattern, with_md5=True, content_max_bytes=n).collect()}
            for n in (1 << 20, 1))
    assert a == b and len(a) == len(NAMES)
    done = spark.createDataFrame([(n,) for n in NAMES[:3]], "project_name string")
    left = skip_done_files(label_documents(spark, str(tmp_path / "labels")), done)
    assert [r.file_name for r in left.collect()] == ["plain.json"]


def test_incremental_labels_with_empty_newest_and_late_older(spark):
    import json

    from seqcat.plans.annotations import label_tasks
    from tests.tree import RECT, _label_doc, _obj
    some = [_obj("o", "boat", "iri:boat", [RECT])]
    docs = [("a.json", "2023-01-01", {"s1": some, "s2": some}), ("b.json", "2023-03-01", {"s1": []}),
            ("c.json", "2022-01-01", {"s1": some, "s2": some})]
    table = spark.createDataFrame([(f, json.dumps(_label_doc(f, date, [
        {"id": s, "name": f"{s}.mp4", "url": "u", "objectOccurrences": o} for s, o in tasks.items()])))
        for f, date, tasks in docs], "filepath string, src_json string").withColumns(
        {"modified": F.lit("2024-01-01").cast("timestamp"), "filesize_bytes": F.lit(1).cast("long")})
    cols = ["sequence_id", "download_date", "label_version", "traits", "x"]
    full = sorted(labels_from_documents(table).select(cols).collect())
    assert [(r.sequence_id, r.label_version, r.traits) for r in full] == [("s2", 2, '{"t":"x"}')]
    old = old_tasks = None
    for f, _, _ in docs:
        part = table.where(F.col("filepath") == f)
        old = labels_from_documents(part, old=old, old_tasks=old_tasks)
        old_tasks = label_tasks(part) if old_tasks is None else old_tasks.unionByName(label_tasks(part))
    assert sorted(old.select(cols).collect()) == full
    again = labels_from_documents(table.where("filepath = 'a.json'"), old=old, old_tasks=old_tasks)  # taken in twice: nothing new
    assert sorted(again.select(cols).collect()) == full


def test_digits_text_numbers_and_elements_that_are_no_frame(spark):
    from seqcat.plans.telemetry import flat_frames, rejected_frames
    text = '[{"seq_frame":1,"feed":{"height_pix":"6","n":12345678901234567.125,"odd\'s":"x","note":"at: NaN"},"platform":{"altitude_ft":NaN},' \
           '"all_fields":{"big":98765432109876543210.5,"slant_range":"2.5"}}, null, 5, "text", [1], {"seq_frame":"2","feed":{"n":"many"}}]'
    docs = spark.createDataFrame([("x", text), ("cut", text[:50]), ("empty", "[]"), ("number", "7"), ("none", None)], "sequence_id string, src_json string")
    rows = {r.sequence_frame: r for r in flat_frames(docs).collect()}
    assert set(rows) == {1, 2}
    r = rows[1]
    assert r.height_pix == 6 and r.slant_range == 2.5 and r.altitude_ft is None and r["odd's"] == "x"
    got = json.loads(r.src_json)
    assert got["feed"]["note"].startswith("at: ") and r.n is not None and rows[2].n == "many"
    plain = docs.withColumn("src_json", F.replace("src_json", F.lit("NaN"), F.lit("1")))  # without a bare NaN every digit stays
    r = flat_frames(plain).where("sequence_frame = 1").first()
    assert '"n":12345678901234567.125' in r.src_json and r.all_fields == '{"big":98765432109876543210.5,"slant_range":"2.5"}'
    assert r.n == "12345678901234567.125" and r.altitude_ft == 1.0
    rejects = sorted((r.sequence_id, r.reason, r.rejected) for r in rejected_frames(docs).where("rejected is not null").collect())
    assert rejects == sorted([("x", "element is no object", e) for e in ("null", "5", '"text"', "[1]")] + [
        ("cut", "no JSON", text[:50]), ("number", "neither array nor object", "7")])
    assert rejected_frames(docs).where("sequence_id = 'none'").first().reason == "no JSON"


def test_open_fields_and_malformed_documents(spark):
    from seqcat.operators.jsonx import infer_json_schema, malformed_documents
    from seqcat.plans.telemetry import flat_frames
    first = '{"seq_frame":"1","feed":{"VARIANT_ID":"v","OBJECT":1.5,"speed":2},"platform":{"speed":3,"a.b":"p"},' \
            '"all_fields":{"odd": 1.50,"slant_range":NaN}}'
    second = '{"seq_frame":"2","feed":{"only_here":7,"height_pix":720}}'
    docs = spark.createDataFrame([("x", f"[{first}, {second}]"), ("one", second), ("cut", f"[{first}"), ("half", first[:30]),
                                  ("text", "hello"), ("none", None), ("empty", "[]")], "sequence_id string, src_json string")
    rows = {(r.sequence_id, r.sequence_frame): r for r in flat_frames(docs).collect()}
    assert set(rows) == {("x", 1), ("x", 2), ("one", 2)}
    r = rows["x", 1]
    assert (r.VARIANT_ID, r.OBJECT, r.speed, r.platform_speed, r.a_b) == ("v", 1.5, 2, 3, "p")
    kept = '{"odd":1.5,"slant_range":"NaN"}'  # written anew: same fields and values, bare NaN quoted
    want = json.loads(first.replace('{"odd": 1.50,"slant_range":NaN}', kept))
    assert json.loads(r.src_json) == want and r.all_fields == kept and r.slant_range is None
    assert rows["x", 2].only_here == 7 == rows["one", 2].only_here and rows["one", 2].height_pix == 720
    bad = {"cut", "half", "text", "none"}
    assert {r.sequence_id for r in malformed_documents(docs, array=True).collect()} == bad
    assert {r.sequence_id for r in malformed_documents(docs).collect()} == bad | {"x", "empty"}
    one = spark.createDataFrame([('{"VARIANT":1,"a OBJECT<b: DECIMAL(1,2)":{"VOID":null}}',)], "j string")
    assert infer_json_schema(one, "j") == "STRUCT<`VARIANT`: BIGINT, `a OBJECT<b: DECIMAL(1,2)`: STRUCT<`VOID`: STRING>>"


def test_catalogue_partitioned_by_batch(built):
    _, t = built
    seqs = t["sequences"]
    plan = seqs.where(F.col("batch") == "no-such-batch")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan
    assert seqs.where(F.col("batch").contains("EDGE")).count() == 2
