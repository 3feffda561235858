"""Golden values for the scalar functions (FIXTURES.md section 4)."""

import datetime

import pytest
from pyspark.sql import functions as F

from seqcat import config as C
from seqcat.functions import (
    batch_from_path,
    binary_class,
    bucketize,
    classify_first_match,
    clip_seconds,
    composite_key,
    gsd_bucket_h,
    gsd_bucket_v,
    ingest_date,
    keyword_flag,
    labeled_objects,
    look_angle,
    look_angle_bucket,
    look_angle_legacy_bucket,
    quality_score,
    seq_id_from_path,
    split_assign,
    split_bucket,
    split_key,
    split_timestamp,
    strip_ext,
    time_of_day_bucket,
    ts_cast,
)

NAN = float("nan")


def one(spark, values, typ, fn):
    if typ == "double":
        values = [float(v) if isinstance(v, int) else v for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_gsd_buckets(spark):
    got = one(spark, [0.02, 0.0208, 3.0, -1.0, None, NAN], "double", gsd_bucket_h)
    assert got == ["hGSD0.25", "hGSD0.5", "hGSDinf", "-", "Missing", "hGSDinf"]
    assert one(spark, [0.5, 1.0], "double", gsd_bucket_v) == ["vGSD8", "vGSD16"]


def test_time_of_day(spark):
    got = one(spark, [0, 41.25, 82.5, 90, 97.5, 138.75, 180, -1, None], "double", time_of_day_bucket)
    assert got == ["Night1", "Night2", "Twilight", "Golden Hour", "Day1", "Day2", "-", "-", "Missing"]


def test_look_angle_buckets(spark):
    vals = [0, 15, 89.9, 90, -1, None]
    assert one(spark, vals, "double", look_angle_bucket) == ["00-15", "15-30", "75-90", "Missing", "Missing", "Missing"]
    assert one(spark, vals, "double", look_angle_legacy_bucket) == ["LA1", "LA2", "LA6", "Missing", "Missing",
                                                                    "Missing"]


def test_bucketize_generic(spark):
    f = lambda c: bucketize(c, [1.0, 2.0], ["a", "b"], null_label="n", neg_label=None, else_label="z")
    assert one(spark, [-5.0, 1.5, 9.0, None], "double", f) == ["a", "b", "z", "n"]


def test_look_angle_values(spark):
    df = spark.createDataFrame([(0, -30.0, -20.0, 2.0, 3.0), (1, -40.0, -35.0, 2.0, 2.2), (2, -20.0, -20.0, 2.0, 2.0)],
                               "i int, eb double, ec double, sb double, sc double")
    got = [r[0] for r in df.orderBy("i").select(F.round(look_angle("eb", "ec", "sb", "sc"), 6)).collect()]
    assert got == [71.373348, 49.982918, None]


def test_quality_score(spark):
    df = spark.createDataFrame([(1, None, "x", None, 2.0)], "a int, b int, c string, d double, e double")
    assert df.select(quality_score(["a", "b", "c", "d", "e"])).first()[0] == 0.6


def test_split_goldens(spark):
    keys = ["198613752", "Batch:demo", "src-3", "src-6"]
    assert one(spark, keys, "string", split_bucket) == [97, 184, 415, 819]
    assert one(spark, [97, 799, 800, 819, 899, 900], "int", split_assign) == [
        "training", "training", "test", "test", "test", "validation"]


def test_split_key_fallback(spark):
    df = spark.createDataFrame([(1, "b"), (None, "b"), (None, None)], "srk bigint, batch string")
    assert [r[0] for r in df.select(split_key("srk", "batch")).collect()] == ["1", "Batch:b", None]


def test_split_depends_on_key_only(spark):
    df = spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3)], "k string, other int")
    got = df.select("k", split_assign(split_bucket("k")).alias("s")).distinct().groupBy("k").count()
    assert all(r["count"] == 1 for r in got.collect())


def test_times(spark):
    assert one(spark, [1641031200123], "bigint", lambda c: ingest_date(c, "ms")) == [
        datetime.datetime(2022, 1, 1, 10, 0)]
    assert one(spark, ["2024-01-01 10:00:00", "nope"], "string", ts_cast) == [datetime.datetime(2024, 1, 1, 10), None]
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 23:30:00' AS t")
    assert df.select(split_timestamp("t")).first()[0] == datetime.datetime(2024, 1, 2, 1, 30)


def test_strings(spark):
    assert one(spark, ["a.mp4.mp4b"], "string", strip_ext) == ["ab"]
    paths = ["/r/b/s/x.tar.gz", "/r/b/.hidden", "/r/b/noext", "/r/b/a.", "/r/b/..a"]
    assert one(spark, paths, "string", seq_id_from_path) == ["x.tar", ".hidden", "noext", "a", "..a"]
    assert one(spark, ["a/b/c", "a"], "string", lambda c: batch_from_path(c, 2)) == ["c", None]
    df = spark.createDataFrame([("s", 3), (None, 4)], "a string, b int")
    assert [r[0] for r in df.select(composite_key("a", "b")).collect()] == ["s-3", "4"]


def test_labeled_objects(spark):
    df = spark.createDataFrame([(0, None), (1, ["a", "b"])], "i int, c array<string>")
    assert [r[0] for r in df.orderBy("i").select(labeled_objects("c")).collect()] == [None, 2]


def test_keyword_flag_and_classes(spark):
    df = spark.createDataFrame([
        (0, "/raw/x_USCG_y/s", "1"), (1, "/raw/EDGE_z/s", "198613766"), (2, "/raw/EDGE_z/s", "5"),
        (3, None, "5"), (4, "/raw/plain/s", None)], "i int, p string, srk string")
    got = [r[0] for r in df.orderBy("i").select(keyword_flag("p", "srk")).collect()]
    assert got == [True, False, True, False, False]
    assert one(spark, ["Maritime Horizontal", "Maritime", None], "string", binary_class) == ["HMI", "FMV", "FMV"]
    assert one(spark, [900, 240, 150, None], "int", clip_seconds) == [30, 8, 5, 5]


@pytest.mark.parametrize("batch,srk,mar,expected", [
    (C.COASTGUARD_BATCHES[0], "1", False, "Coastguard-CDAO"),
    (C.EDGE_BATCHES[0], C.EDGE_FM_SRKS[0], True, "Fixed Maritime Horizontal"),
    (C.EDGE_BATCHES[0], C.EDGE_FT_SRKS[0], True, "Fixed Terrestrial Horizontal"),
    (C.EDGE_BATCHES[0], "7", False, "Maritime Horizontal"),
    ("x_MAVEN_HMI-FMH_y", "7", False, "Fixed Maritime Horizontal"),
    ("plain", "7", True, "Maritime"),
    ("a_CCTV", "7", False, "Fixed Terrestrial Horizontal"),
    ("SpecialFMV", "7", False, "NDS"),
    ("plain", "7", None, "CT/COIN"),
])
def test_mission_type(spark, batch, srk, mar, expected):
    df = spark.createDataFrame([(batch, srk, mar)], "batch string, src_record_key string, is_maritime boolean")
    assert df.select(classify_first_match(C.MISSION_TYPE_RULES, C.MISSION_TYPE_DEFAULT)).first()[0] == expected
