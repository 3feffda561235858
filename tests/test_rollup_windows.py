"""Roll-ups, windows, dedup, neighbours, boxes: goldens, hot-path equality and plan checks."""

import datetime

from pyspark.sql import functions as F

from seqcat.operators import (
    bbox_polygon,
    bbox_rect,
    bbox_union,
    exact_row_number,
    fill_from_group,
    latest_per_key,
    mode_clean,
    modes_and_medians,
    crowded_slots,
    neighbours,
    potential_dupes,
    starts_and_ends,
    upper_median,
    version_number,
)
from tests.conftest import SF_SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_upper_median_and_mode_goldens(spark):
    df = spark.createDataFrame([("s", v) for v in [0.5, 0.0, 1.5, 2.5, None, 3.5]], "k string, v double")
    assert upper_median(df, "k", "v").first()["v"] == 2.5
    df = spark.createDataFrame([("s", v) for v in ["", "EO", "IR", "IR", "Missing", "EO"]], "k string, v string")
    assert mode_clean(df, "k", "v").first()["v"] == "EO"


def test_hot_path_equals_cold_path(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(
        "value", F.when(F.col("event_id") % 7 == 0, F.lit(0.0)).otherwise(F.col("value")))
    cold = modes_and_medians(ev.select("user_id", "event_type", "props", "value"), "user_id")
    hot = modes_and_medians(ev.select("user_id", "event_type", "props", "value"), "user_id", hot_threshold=0,
                            n_blocks=4)
    assert _sorted(cold) == _sorted(hot)
    # one big group split over several blocks
    a = upper_median(ev, "event_type", "value")
    b = upper_median(ev, "event_type", "value", hot_threshold=5, n_blocks=8)
    assert _sorted(a) == _sorted(b)


def test_rollup_has_no_python_udf(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = modes_and_medians(ev.select("user_id", "event_type", "value"), "user_id")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_row_number_hot_equals_window(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts")
    a = version_number(ev, "user_id", ["ts", "event_id"])
    b = exact_row_number(ev, ["user_id"], ["ts", "event_id"], out="version", hot_threshold=3, n_blocks=5)
    assert _sorted(a) == _sorted(b)


def test_latest_and_versions(spark):
    t = datetime.datetime
    df = spark.createDataFrame([("s1", t(2022, 1, 1), "a"), ("s1", t(2022, 1, 2), "b"), ("s2", None, "c"),
                                (None, t(2022, 1, 1), "d")], "sequence_id string, modified timestamp, filepath string")
    latest = {r.sequence_id: r.filepath for r in latest_per_key(df).collect()}
    assert latest == {"s1": "b", "s2": "c", None: "d"}
    v = {r.filepath: r.version for r in version_number(df).collect()}
    assert v == {"a": 1, "b": 2, "c": 1, "d": 1}


def test_potential_dupes(spark):
    df = spark.createDataFrame([("s1", "m"), ("s2", "m"), ("s3", None), ("s4", None), ("s5", "z")],
                               "sequence_id string, md5_hash string")
    got = {r.sequence_id: (r.potential_dupe_count, r.first_potential_dupe) for r in potential_dupes(df).collect()}
    assert got == {"s1": (1, "s2"), "s2": (1, "s1"), "s3": (None, None), "s4": (None, None), "s5": (0, None)}


def test_potential_dupes_of_repeats_and_null_ids(spark):
    rows = [("b", "m"), ("b", "m"), ("a", "m"), ("c", "m"), (None, "m"), (None, "n"), ("d", "n"), (None, "o")]
    out = potential_dupes(spark.createDataFrame(rows, "sequence_id string, md5_hash string"))
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2  # before and after the shuffle
    got = sorted(map(str, map(tuple, out.collect())))
    assert got == sorted(map(str, [
        ("b", "m", 3, "a"), ("b", "m", 3, "a"), ("a", "m", 3, "b"), ("c", "m", 3, "a"), (None, "m", 3, "a"),
        (None, "n", 1, "d"), ("d", "n", 1, None), (None, "o", 0, None)]))


def test_fill_from_group_casts_before_max(spark):
    df = spark.createDataFrame([("r", "9", None), ("r", "10", None), ("r", None, None), ("q", None, "7")],
                               "src_record_key string, width string, width_pix string")
    got = sorted((r.src_record_key, r.width) for r in fill_from_group(df, names=["width"]).collect())
    assert got == [("q", 7), ("r", 9), ("r", 10), ("r", 10)]


def test_starts_and_ends(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0), ("a", 3, 30.0), ("b", 2, 5.0)],
                               "sequence_id string, sequence_frame int, x double")
    got = {(r.sequence_id, r.sequence_frame): (r.start_x, r.end_x)
           for r in starts_and_ends(df, cols=["x"], last=None).collect()}
    assert got[("a", 2)] == (10.0, 30.0) and got[("b", 2)] == (None, 5.0)
    fixed = starts_and_ends(df, cols=["x"])  # last frame 150: absent -> null
    assert {r.end_x for r in fixed.collect()} == {None}


def test_neighbours_golden(spark):
    df = spark.createDataFrame([("a", "r", 0.0), ("b", "r", 5.0), ("c", "r", 10.0), ("d", "r", 20.0), ("e", "q", 0.0)],
                               "sequence_id string, src_record_key string, time_offset_s double")
    out = neighbours(df, length=F.lit(5))
    got = {r.sequence_id: (r.next_sequence_id, r.prev_sequence_id) for r in out.collect()}
    assert got == {"a": ("b", None), "b": ("c", "a"), "c": (None, "b"), "d": (None, None), "e": (None, None)}


def test_neighbours_clip_length_from_candidate_batch(spark):
    # candidate's batch has 900-frame clips -> 30 s
    df = spark.createDataFrame([("a", "r", 0.0, 240), ("b", "r", 30.0, 900), ("c", "r", 8.0, 240)],
                               "sequence_id string, src_record_key string, time_offset_s double, max_frame_count int")
    got = sorted((r.sequence_id, r.next_sequence_id) for r in neighbours(df).collect())
    # b starts 30 s after a (its own batch: 30 s clips), c 8 s after a: both follow a
    assert got == [("a", "b"), ("a", "c"), ("b", None), ("c", None)]


def test_neighbours_without_fan_out(spark):
    rows = [("a", "r", 0.0), ("b", "r", 5.0), ("b2", "r", 5.0), ("c", "r", 10.0), ("c", "r", 10.0), ("x", None, 5.0), ("y", "r", None),
            (None, "q", 0.0), (None, "q", 0.0)]
    df = spark.createDataFrame(rows, "sequence_id string, src_record_key string, time_offset_s double")
    got = neighbours(df, length=F.lit(5), fan_out=False)
    assert got.columns == ["sequence_id", "src_record_key", "time_offset_s", "next_sequence_id", "next_sequence_id_count",
                           "prev_sequence_id", "prev_sequence_id_count"]
    have = sorted((str(r[0]), *r[3:]) for r in got.collect())
    assert have == sorted([("a", "b", 2, None, 0), ("b", "c", 2, "a", 1), ("b2", "c", 2, "a", 1), ("c", None, 0, "b", 2), ("c", None, 0, "b", 2),
                           ("x", None, 0, None, 0), ("y", None, 0, None, 0), ("None", None, 0, None, 0), ("None", None, 0, None, 0)], key=lambda r: r[0])
    assert sorted(map(tuple, crowded_slots(df).collect()), key=str) == [("q", 0, 2, None), ("r", 10000, 2, "c"), ("r", 5000, 2, "b")]
    # with fan-out: as many rows as next times previous candidates
    many = neighbours(df, length=F.lit(5))
    each = got.selectExpr("greatest(next_sequence_id_count, 1) * greatest(prev_sequence_id_count, 1) AS n").agg(F.sum("n")).first()[0]
    assert many.count() == each
    assert neighbours(df.limit(0), length=F.lit(5), fan_out=False).count() == 0 and crowded_slots(df.limit(0)).count() == 0


def test_neighbours_hot_slot_is_linear(spark):
    hot = spark.range(60_000).selectExpr("id AS sequence_id", "'r' AS src_record_key", "CAST(5 * (id % 2) AS double) AS time_offset_s")
    got = neighbours(hot, length=F.lit(5), fan_out=False)
    assert got.count() == 60_000  # 30,000 candidates each: 900 million rows with fan-out
    assert got.where("next_sequence_id_count = 30000 AND next_sequence_id = 1").count() == 30_000


def test_neighbours_deal_the_wide_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(10).selectExpr("id AS sequence_id", "id AS src_record_key", "CAST(id AS double) AS time_offset_s", "'wide' || id AS payload")
        plan = neighbours(df, length=F.lit(1))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3  # rows once, candidates of each direction


def _coords_df(spark):
    return spark.createDataFrame([
        (1, "AnnoRect", ([], 576.0, 592.0, 250.0, 256.0)),
        (2, "AnnoPolygon", ([(1.0, 5.0), (3.0, 2.0)], None, None, None, None)),
        (3, "AnnoPolygon", ([(4.0, 4.0)], None, None, None, None)),
        (4, "Other", ([], 0.0, 1.0, 0.0, 1.0)),
    ], "id int, type string, coords struct<points: array<struct<x: double, y: double>>, xMin: double, "
       "xMax: double, yMin: double, yMax: double>")


def test_boxes(spark):
    df = _coords_df(spark)
    r = bbox_rect(df).first()
    assert (r.x, r.y, r.width, r.height) == (576.0, 250.0, 16.0, 6.0)
    p = {row.id: (row.x, row.y, row.width, row.height) for row in bbox_polygon(df).collect()}
    assert p == {2: (1.0, 2.0, 2.0, 3.0), 3: (4.0, 4.0, 0.0, 0.0)}
    u = bbox_union(df)
    assert sorted(row.id for row in u.collect()) == [1, 2, 3]
    assert all(row.width >= 0 and row.height >= 0 for row in u.collect())
    assert "Exchange" not in u._jdf.queryExecution().executedPlan().toString()


def test_next_prev_inverse_when_offsets_unique(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("sequence_id"),
        F.col("l_orderkey").cast("string").alias("src_record_key"), "l_linenumber")
    li = li.dropDuplicates(["src_record_key", "l_linenumber"]).withColumn(
        "time_offset_s", F.col("l_linenumber") * 5.0)
    n = neighbours(li, length=F.lit(5))
    by_id = {r.sequence_id: r for r in n.collect()}
    assert len(by_id) == li.count()
    for r in by_id.values():
        if r.next_sequence_id is not None:
            assert by_id[r.next_sequence_id].prev_sequence_id == r.sequence_id


def test_dimension_and_global_rows_are_broadcast(spark):
    from seqcat.operators import dim_lookup, global_averages
    cu = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    na = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    plan = dim_lookup(cu, na, "c_nationkey", rename={"n_nationkey": "c_nationkey"})._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    g = global_averages(cu, ["c_acctbal"])
    assert "Join" not in g._jdf.queryExecution().executedPlan().toString()
    avg = cu.agg(F.avg("c_acctbal")).first()[0]
    assert {r.global_average_c_acctbal for r in g.collect()} == {avg}


def test_hot_path_two_keys_and_descending(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "event_type", "ts", "value")
    keys = ["user_id", "event_type"]
    cold = modes_and_medians(ev.drop("event_id", "ts"), keys)
    hot = modes_and_medians(ev.drop("event_id", "ts"), keys, hot_threshold=1, n_blocks=3)
    assert _sorted(cold) == _sorted(hot)
    a = exact_row_number(ev, keys, ["ts", "event_id"], out="r", descending=True)
    b = exact_row_number(ev, keys, ["ts", "event_id"], out="r", descending=True, hot_threshold=2, n_blocks=4)
    assert _sorted(a) == _sorted(b)
    first = {(r.user_id, r.event_type): r.event_id for r in a.where("r = 1").collect()}
    want = {(r.user_id, r.event_type): r.event_id for r in latest_per_key(ev, keys, ["ts", "event_id"]).collect()}
    assert first == want


def test_blocked_ranks_across_dst_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("""SELECT 'g' AS k, i, timestampadd(MINUTE, i * 7, TIMESTAMP_NTZ'2024-03-10 01:00:00') AS t
                          FROM range(60) AS r(i)""")
        a = exact_row_number(df, ["k"], ["t", "i"], out="r")
        b = exact_row_number(df, ["k"], ["t", "i"], out="r", hot_threshold=1, n_blocks=8)
        assert _sorted(a) == _sorted(b)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_blocked_ranks_split_a_huge_tie(spark):
    from seqcat.operators.ranks import range_placed
    # 70% of the rows share one timestamp: the tie must be split by the second order column
    df = spark.sql("""SELECT 'g' AS k, i, CASE WHEN i % 10 < 7 THEN TIMESTAMP_NTZ'2024-01-01 00:00:00'
                      ELSE timestampadd(SECOND, i, TIMESTAMP_NTZ'2024-01-01 00:00:00') END AS t FROM range(2000) AS r(i)""")
    for desc in (False, True):
        a = exact_row_number(df, ["k"], ["t", "i"], out="r", descending=desc)
        b = exact_row_number(df, ["k"], ["t", "i"], out="r", descending=desc, hot_threshold=10, n_blocks=8)
        assert _sorted(a) == _sorted(b)
    placed = range_placed(df, ["k"], [F.col("t"), F.col("i")], 8)
    tied = placed.where(F.col("t") == F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert tied.select("_part").distinct().count() >= 4


def test_row_numbers_by_text_and_nulls_spread_a_hot_group(spark):
    from seqcat.operators.ranks import range_placed
    # one group: ordered by text; 90 % null in the first column; equal rows; and a null key
    df = spark.sql("""SELECT CASE WHEN i < 4000 THEN 'g' END AS k, CASE WHEN i % 10 = 0 THEN concat('t', i % 97, 'é') END AS a,
                      concat('name ', i % 1000) AS b, CAST(NULL AS map<string, int>) AS m, i - i % 2 AS i FROM range(4400) AS r(i)""")
    for order in (["a", "b", "i"], ["b", "i"]):
        for desc in (False, True):
            a = exact_row_number(df, ["k"], order, out="r", descending=desc).drop("m")
            b = exact_row_number(df, ["k"], order, out="r", descending=desc, hot_threshold=300, n_blocks=16).drop("m")
            assert _sorted_nulls(a) == _sorted_nulls(b)
        sizes = range_placed(df, ["k"], [F.col(c) for c in order], 16).groupBy("_part").count().collect()
        assert len(sizes) >= 12 and max(r["count"] for r in sizes) < 4400 / 5


def _sorted_nulls(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_hot_keys_without_a_full_count(spark):
    from seqcat.operators.skew import hot_key_table, split_hot
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("user_id"), "event_type", "value")
    for keys, threshold in ((["user_id"], 40), (["user_id", "event_type"], 12), (["event_type"], 10 ** 6), (["user_id"], 0)):
        want = ev.groupBy(*keys).count().where(F.col("count") > threshold).drop("count")
        hot = hot_key_table(ev, keys, threshold)
        assert _sorted_nulls(want) == ([] if hot is None else _sorted_nulls(hot))
        if hot is not None:
            cold_rows, hot_rows = split_hot(ev, keys, hot)
            assert cold_rows.count() + hot_rows.count() == ev.count() and cold_rows.groupBy(*keys).count().where(F.col("count") > threshold).isEmpty()


def test_selected_ranks_on_odd_doubles(spark):
    from seqcat.operators.ranks import select_ranks
    import random
    r = random.Random(4)
    inf, tiny = float("inf"), 5e-324
    groups = {"one": [3.0], "same": [2.5] * 9, "two": [1.0, 2.0], "ends": [-inf, inf, 1.0, -inf], "infs": [inf] * 3 + [1.0], "huge": [-1.7e308, 1.7e308, 1e300, 5.0],
              "tiny": [tiny * k for k in range(1, 60)], "near": [1.0 + k * 2.0 ** -52 for k in range(300)],
              "spread": [r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300) for _ in range(500)], "skew": [1e-9 * k for k in range(400)] + [1e9],
              "ties": [float(r.randint(1, 4)) for _ in range(200)], None: [-0.5, 0.25, 7.0]}
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    for bins in (32, 4096):
        got = select_ranks(spark.createDataFrame(rows, "k string, v double").repartition(3), ["k"], "v", F.floor(F.col("_n") / 2), bins)
        assert {x["k"]: x["v"] for x in got.collect()} == {k: sorted(vs)[len(vs) // 2] for k, vs in groups.items()}


def test_dupe_members(spark):
    from seqcat.operators import dupe_members
    df = spark.createDataFrame([("s1", "m"), ("s2", "m"), ("s2", "m"), ("s3", None), ("s5", "z")],
                               "sequence_id string, md5_hash string")
    assert sorted(tuple(r) for r in dupe_members(df).collect()) == [("m", "s1"), ("m", "s2")]
