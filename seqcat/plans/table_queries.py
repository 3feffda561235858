"""Every operator exercised on the driver's tables, each with its DuckDB oracle SQL.

The tables hold no video data, so each operator (whose column names are
parameters) runs on a proxy shape built from the given tables; the comment of
each query says which.  All queries read whole tables.  Arrays for the
explode/box operators are built row-locally from ``embeddings`` (no grouping).
Queries that exercise file sources first write the table rows as files under
the session's shared checkpoint folder, then read them back.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqcat import config as C
from seqcat import schemas
from seqcat.functions import (
    batch_from_path,
    binary_class,
    classify_first_match,
    composite_key,
    gsd_bucket_h,
    gsd_bucket_v,
    ingest_date,
    is_labeled,
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
from seqcat.functions.classify import clip_seconds
from seqcat.operators.jsonx import JSON_OPTIONS, malformed_documents, tagged_frames
from seqcat.operators import (
    add_label_size,
    annotation_members,
    annotation_struct,
    append_union,
    bbox_polygon,
    bbox_rect,
    bbox_union,
    cluster_by_key,
    coalesce_counts,
    crowded_slots,
    const_cols,
    derive_frame_cols,
    derive_gsd,
    derive_telemetry,
    dim_lookup,
    distinct_rows,
    dupe_members,
    expand_json,
    explode_annotations,
    explode_frames,
    explode_objects,
    explode_tasks,
    fill_from_group,
    first_label,
    flatten_frame,
    frame_count,
    global_averages,
    group_labels,
    label_join,
    label_report,
    latest_per_key,
    max_per_group,
    merge_sources,
    mode_clean,
    modes_and_medians,
    nan_to_null,
    neighbour,
    neighbours,
    parse_json,
    potential_dupes,
    prefix_cols,
    recast_cols,
    rename_cols,
    replace_sentinel,
    skip_done,
    skip_done_files,
    sort_catalogue,
    source_allowlist,
    starts_and_ends,
    sum_matching_cols,
    to_json_cols,
    upper_median,
    version_number,
)
from seqcat.plans.annotations import label_table, label_tasks, labels_from_documents
from seqcat.plans.telemetry import flat_frames
from seqcat.plans._sqlgen import case_buckets, case_rules
from seqcat.session import scratch_dir
from seqcat.sources import (
    dim_read,
    export_csv,
    file_catalogue,
    first_file_per_dir,
    json_documents,
    stage_read,
    stage_write,
)
from seqcat.streaming import fold_latest, read_epochs, read_latest, stream_ingest, stream_ingest_rejects, stream_latest

# The driver runs the oracle side at this scale folder.
ORACLE_DIR = "/root/testdata/sf0.01"

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def tbl(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def r6(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------------------
# A. frames -> sequence summary (events: frame = event, sequence = user_id)
# ---------------------------------------------------------------------------

def _mode_sql(src: str, key: str, col: str, alias: str) -> str:
    return f"""(SELECT {key}, {col} AS {alias} FROM (
        SELECT {key}, {col}, row_number() OVER (PARTITION BY {key} ORDER BY c DESC, {col}) AS rn
        FROM (SELECT {key}, {col}, count(*) AS c FROM {src}
              WHERE {col} IS NOT NULL AND {col} NOT IN ('', 'Missing') GROUP BY {key}, {col}))
      WHERE rn = 1)"""


def _median_sql(src: str, key: str, col: str, alias: str) -> str:
    return f"""(SELECT {key}, list_sort(list({col}))[1 + (count(*) // 2)] AS {alias} FROM {src}
      WHERE {col} IS NOT NULL AND NOT isnan({col}) AND {col} <> 0 GROUP BY {key})"""


_TOD_SQL = case_buckets("value", C.TIME_OF_DAY_BOUNDS, C.TIME_OF_DAY_LABELS, C.MISSING, C.NEGATIVE, C.NEGATIVE)


def sequence_summary(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: NaN clean-up -> bucket -> per-sequence modes/medians -> metadata quality."""
    frames = tbl(spark, d, "events").select(
        F.col("user_id").alias("sequence_id"), F.col("event_type").alias("sensor_band"), "value")
    frames = nan_to_null(frames).withColumn("time_of_day", time_of_day_bucket("value"))
    seqs = modes_and_medians(frames, "sequence_id", mode_cols=["sensor_band", "time_of_day"], median_cols=["value"])
    return seqs.withColumn("metadata_quality", quality_score(["sensor_band", "value", "time_of_day"]))


register("sequence_summary", f"""
WITH f AS (SELECT user_id AS sequence_id, event_type AS sensor_band, value, {_TOD_SQL} AS time_of_day FROM events),
b AS (SELECT sequence_id, count(*) AS frame_count FROM f GROUP BY sequence_id)
SELECT b.sequence_id, b.frame_count, m1.sensor_band, m2.time_of_day, md.value,
       round(((m1.sensor_band IS NOT NULL)::INTEGER + (md.value IS NOT NULL)::INTEGER
              + (m2.time_of_day IS NOT NULL)::INTEGER)::DOUBLE / 3.0, 2) AS metadata_quality
FROM b LEFT JOIN {_mode_sql('f', 'sequence_id', 'sensor_band', 'sensor_band')} m1 USING (sequence_id)
LEFT JOIN {_mode_sql('f', 'sequence_id', 'time_of_day', 'time_of_day')} m2 USING (sequence_id)
LEFT JOIN {_median_sql('f', 'sequence_id', 'value', 'value')} md USING (sequence_id)
""")(sequence_summary)


@register("frame_count", "SELECT user_id, count(*) AS frame_count FROM events GROUP BY user_id")
def q_frame_count(spark, d):
    return frame_count(tbl(spark, d, "events"), "user_id")


@register("mode_clean", f"""
SELECT u.user_id, m.event_type FROM (SELECT DISTINCT user_id FROM events) u
LEFT JOIN {_mode_sql('events', 'user_id', 'event_type', 'event_type')} m USING (user_id)""")
def q_mode_clean(spark, d):
    return mode_clean(tbl(spark, d, "events"), "user_id", "event_type")


@register("upper_median", f"""
SELECT g.event_type, m.value FROM (SELECT DISTINCT event_type FROM events) g
LEFT JOIN {_median_sql('events', 'event_type', 'value', 'value')} m USING (event_type)""")
def q_upper_median(spark, d):
    # few, large groups: exercises the block split of one group over many tasks
    return upper_median(tbl(spark, d, "events"), "event_type", "value")


@register("modes_and_medians", f"""
WITH b AS (SELECT user_id, count(*) AS frame_count FROM events GROUP BY user_id)
SELECT b.user_id, b.frame_count, m1.event_type, m2.props, md.value FROM b
LEFT JOIN {_mode_sql('events', 'user_id', 'event_type', 'event_type')} m1 USING (user_id)
LEFT JOIN {_mode_sql('events', 'user_id', 'props', 'props')} m2 USING (user_id)
LEFT JOIN {_median_sql('events', 'user_id', 'value', 'value')} md USING (user_id)""")
def q_modes_and_medians(spark, d):
    return modes_and_medians(tbl(spark, d, "events").select("user_id", "event_type", "props", "value"), "user_id")


@register("quality_score", """
SELECT l_orderkey, l_linenumber,
  round(((nullif(l_discount, 0.0) IS NOT NULL)::INTEGER + (nullif(l_tax, 0.0) IS NOT NULL)::INTEGER
         + (nullif(l_returnflag, 'N') IS NOT NULL)::INTEGER)::DOUBLE / 3.0, 2) AS metadata_quality
FROM lineitem""")
def q_quality_score(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("a"),
        F.nullif("l_tax", F.lit(0.0)).alias("b"), F.nullif("l_returnflag", F.lit("N")).alias("c"))
    return li.select("l_orderkey", "l_linenumber", quality_score(["a", "b", "c"]).alias("metadata_quality"))


@register("nan_to_null", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS discount,
       l_tax FROM lineitem""")
def q_nan_to_null(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("discount"),
        "l_tax")
    return nan_to_null(li)


@register("replace_sentinel", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS l_returnflag,
       CASE WHEN l_linestatus = 'N' THEN '' ELSE l_linestatus END AS l_linestatus FROM lineitem""")
def q_replace_sentinel(spark, d):
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return replace_sentinel(li, sentinel="N")


@register("coalesce_counts", """
SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0.0), l_tax) AS fps,
       coalesce(nullif(l_linenumber, 1), l_linenumber * 10) AS frame_count, l_quantity AS srk_frame_count
FROM lineitem""")
def q_coalesce_counts(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("seq_fps"), F.col("l_tax").alias("fps"),
        F.nullif("l_linenumber", F.lit(1)).alias("seq_nb_frames"), (F.col("l_linenumber") * 10).alias("frame_count"),
        F.col("l_quantity").alias("nb_frames"))
    return coalesce_counts(li)


_LA_INPUTS = """l_quantity - 60.0 AS eb, l_linenumber * -3.0 AS ec, 1.0 + l_tax * 10.0 AS sb,
                1.0 + l_discount * 10.0 AS sc"""
_LA_SQL = """(pi() / 2 - CASE WHEN abs(ratio) <= 1 THEN asin(ratio) END) / (pi() / 180)"""
_LA_CTE = f"""
a0 AS (SELECT l_orderkey, l_linenumber, l_quantity, {_LA_INPUTS} FROM lineitem),
a1 AS (SELECT *, (ec - eb) * (pi() / 180) AS spread FROM a0),
a2 AS (SELECT *, sb * sb + sc * sc - 2.0 * sb * sc * cos(spread) AS rad FROM a1),
a3 AS (SELECT *, (sb * sin(spread)) / CASE WHEN rad > 0 THEN sqrt(rad) END AS ratio FROM a2),
a4 AS (SELECT *, {_LA_SQL} AS la FROM a3)"""


def _angle_frame(spark, d):
    return tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        (F.col("l_quantity") - 60.0).alias("bottom_middle_elevation_angle_deg"),
        (F.col("l_linenumber") * -3.0).alias("center_elevation_angle_deg"),
        (F.lit(1.0) + F.col("l_tax") * 10.0).alias("bottom_middle_slant_range_nmi"),
        (F.lit(1.0) + F.col("l_discount") * 10.0).alias("center_slant_range_nmi"))


@register("look_angle", f"WITH {_LA_CTE} SELECT l_orderkey, l_linenumber, round(la, 6) AS look_angle_deg FROM a4")
def q_look_angle(spark, d):
    return _angle_frame(spark, d).select("l_orderkey", "l_linenumber", r6(look_angle()).alias("look_angle_deg"))


_PHI = "l_quantity * 3.7 - 5.0"


@register("derive_telemetry", f"""WITH {_LA_CTE}
SELECT l_orderkey, l_linenumber,
  {case_buckets(_PHI, C.TIME_OF_DAY_BOUNDS, C.TIME_OF_DAY_LABELS, C.MISSING, C.NEGATIVE, C.NEGATIVE)} AS time_of_day,
  round(la, 6) AS look_angle_deg,
  {case_buckets('la', C.LOOK_ANGLE_BOUNDS, C.LOOK_ANGLE_LABELS, C.MISSING, C.MISSING, C.MISSING)} AS look_angle,
  {case_buckets('la', C.LOOK_ANGLE_BOUNDS, C.LOOK_ANGLE_LEGACY_LABELS, C.MISSING, C.MISSING, C.MISSING)}
    AS look_angle_legacy
FROM a4""")
def q_derive_telemetry(spark, d):
    fr = _angle_frame(spark, d).withColumn("solar_ned_phi", F.col("l_quantity") * 3.7 - 5.0)
    out = derive_telemetry(fr)
    return out.select("l_orderkey", "l_linenumber", "time_of_day", r6("look_angle_deg").alias("look_angle_deg"),
                      "look_angle", "look_angle_legacy")


def _gsd_sql(expr, prefix):
    return case_buckets(expr, C.GSD_BOUNDS, [prefix + s for s in C.GSD_SUFFIXES], C.MISSING, C.NEGATIVE,
                        prefix + C.GSD_INF_SUFFIX)


@register("derive_gsd", f"""
SELECT l_orderkey, l_linenumber,
  {_gsd_sql('l_tax', 'vGSD')} AS gsd_v_top, {_gsd_sql('l_discount', 'hGSD')} AS gsd_h_top,
  {_gsd_sql('l_tax * 2.0', 'vGSD')} AS gsd_v_center, {_gsd_sql('l_discount * 2.0', 'hGSD')} AS gsd_h_center,
  {_gsd_sql('l_tax * 4.0', 'vGSD')} AS gsd_v_bottom, {_gsd_sql('l_discount * 4.0', 'hGSD')} AS gsd_h_bottom,
  (l_discount * 2.0) * 12.0 AS gsd
FROM lineitem""")
def q_derive_gsd(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_tax").alias("top_middle_vert_ires_ft"), F.col("l_discount").alias("top_middle_horz_ires_ft"),
        (F.col("l_tax") * 2.0).alias("center_vert_ires_ft"), (F.col("l_discount") * 2.0).alias("center_horz_ires_ft"),
        (F.col("l_tax") * 4.0).alias("bottom_middle_vert_ires_ft"),
        (F.col("l_discount") * 4.0).alias("bottom_middle_horz_ires_ft"))
    out = derive_gsd(li)
    return out.select("l_orderkey", "l_linenumber", "gsd_v_top", "gsd_h_top", "gsd_v_center", "gsd_h_center",
                      "gsd_v_bottom", "gsd_h_bottom", "gsd")


@register("derive_frame_cols", """
SELECT l_orderkey, l_linenumber, l_quantity AS elevation_angle_degree, (l_discount + l_tax) / 2 AS avg_center_ires_ft
FROM lineitem""")
def q_derive_frame_cols(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("center_elevation_angle_deg"),
        F.col("l_discount").alias("center_horz_ires_ft"), F.col("l_tax").alias("center_vert_ires_ft"))
    return derive_frame_cols(li).select("l_orderkey", "l_linenumber", "elevation_angle_degree", "avg_center_ires_ft")


_BUCKET_INPUTS = {
    "bucket_hgsd": ("nullif(l_discount, 0.05)", lambda: F.nullif("l_discount", F.lit(0.05)), gsd_bucket_h,
                    (C.GSD_BOUNDS, [f"hGSD{s}" for s in C.GSD_SUFFIXES], C.MISSING, C.NEGATIVE, "hGSDinf")),
    "bucket_vgsd": ("l_tax", lambda: F.col("l_tax"), gsd_bucket_v,
                    (C.GSD_BOUNDS, [f"vGSD{s}" for s in C.GSD_SUFFIXES], C.MISSING, C.NEGATIVE, "vGSDinf")),
    "bucket_time_of_day": (_PHI, lambda: F.col("l_quantity") * 3.7 - 5.0, time_of_day_bucket,
                           (C.TIME_OF_DAY_BOUNDS, C.TIME_OF_DAY_LABELS, C.MISSING, C.NEGATIVE, C.NEGATIVE)),
    "bucket_look_angle": ("l_quantity * 1.9 - 2.0", lambda: F.col("l_quantity") * 1.9 - 2.0, look_angle_bucket,
                          (C.LOOK_ANGLE_BOUNDS, C.LOOK_ANGLE_LABELS, C.MISSING, C.MISSING, C.MISSING)),
    "bucket_look_angle_legacy": ("l_quantity * 1.9 - 2.0", lambda: F.col("l_quantity") * 1.9 - 2.0,
                                 look_angle_legacy_bucket,
                                 (C.LOOK_ANGLE_BOUNDS, C.LOOK_ANGLE_LEGACY_LABELS, C.MISSING, C.MISSING, C.MISSING)),
}


def _bucket_query(make_input, fn):
    def run(spark, d):
        li = tbl(spark, d, "lineitem")
        return li.select("l_orderkey", "l_linenumber", fn(make_input()).alias("bucket"))
    return run


for _name, (_sql_in, _mk, _fn, _args) in _BUCKET_INPUTS.items():
    register(_name, f"SELECT l_orderkey, l_linenumber, {case_buckets(_sql_in, *_args)} AS bucket FROM lineitem")(
        _bucket_query(_mk, _fn))


@register("global_averages", """
SELECT l.l_orderkey, l.l_linenumber, round(g.q, 6) AS global_average_l_quantity,
       round(g.p, 6) AS global_average_l_extendedprice, round(g.d, 6) AS global_average_l_discount
FROM lineitem l CROSS JOIN (SELECT avg(l_quantity) q, avg(l_extendedprice) p, avg(l_discount) d FROM lineitem) g""")
def q_global_averages(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    out = global_averages(tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *cols), cols)
    return out.select("l_orderkey", "l_linenumber", *[r6(f"global_average_{c}").alias(f"global_average_{c}")
                                                      for c in cols])


@register("max_per_group", """
SELECT c.c_custkey, c.c_nationkey, m.max_acctbal FROM customer c
LEFT JOIN (SELECT c_nationkey, max(c_acctbal) AS max_acctbal FROM customer GROUP BY c_nationkey) m
  ON m.c_nationkey = c.c_nationkey""")
def q_max_per_group(spark, d):
    cu = tbl(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return max_per_group(cu, "c_nationkey", "c_acctbal", "max_acctbal").drop("c_acctbal")


@register("starts_and_ends", """
SELECT l_orderkey, l_linenumber,
  max(CASE WHEN l_linenumber = 1 THEN l_quantity END) OVER w AS start_l_quantity,
  max(CASE WHEN l_linenumber = 7 THEN l_quantity END) OVER w AS end_l_quantity,
  max(CASE WHEN l_linenumber = 1 THEN l_tax END) OVER w AS start_l_tax,
  max(CASE WHEN l_linenumber = 7 THEN l_tax END) OVER w AS end_l_tax
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)""")
def q_starts_and_ends(spark, d):
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    out = starts_and_ends(li, "l_orderkey", "l_linenumber", ["l_quantity", "l_tax"], first=1, last=7)
    return out.drop("l_quantity", "l_tax")


# ---------------------------------------------------------------------------
# windows / dedup
# ---------------------------------------------------------------------------

@register("version_number", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM events""")
def q_version_number(spark, d):
    ev = tbl(spark, d, "events").select("event_id", "user_id", "ts")
    return version_number(ev, "user_id", ["ts", "event_id"]).select("event_id", "user_id", "version")


_LATEST_EVENTS = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)"""


@register("latest_per_key", f"SELECT * FROM {_LATEST_EVENTS}")
def q_latest_per_key(spark, d):
    return latest_per_key(tbl(spark, d, "events"), "user_id", ["ts", "event_id"])


@register("potential_dupes", """
WITH p AS (SELECT DISTINCT md5(text) AS h, doc_id FROM documents WHERE text IS NOT NULL),
s AS (SELECT h, count(*) AS cnt, min(doc_id) AS m1 FROM p GROUP BY h),
s2 AS (SELECT p.h, min(p.doc_id) AS m2 FROM p JOIN s ON p.h = s.h WHERE p.doc_id <> s.m1 GROUP BY p.h)
SELECT d.doc_id, md5(d.text) AS md5_hash, s.cnt - 1 AS potential_dupe_count,
       CASE WHEN d.doc_id = s.m1 THEN s2.m2 ELSE s.m1 END AS first_potential_dupe
FROM documents d LEFT JOIN s ON s.h = md5(d.text) LEFT JOIN s2 ON s2.h = s.h""")
def q_potential_dupes(spark, d):
    docs = tbl(spark, d, "documents").select("doc_id", F.md5("text").alias("md5_hash"))
    return potential_dupes(docs, "doc_id", "md5_hash")


@register("dupe_members", """
WITH p AS (SELECT DISTINCT md5(text) AS md5_hash, doc_id FROM documents WHERE text IS NOT NULL)
SELECT md5_hash, doc_id FROM p WHERE md5_hash IN (SELECT md5_hash FROM p GROUP BY md5_hash HAVING count(*) > 1)""")
def q_dupe_members(spark, d):
    docs = tbl(spark, d, "documents").select("doc_id", F.md5("text").alias("md5_hash"))
    return dupe_members(docs, "doc_id", "md5_hash")


@register("distinct_rows", "SELECT DISTINCT text, lang, source FROM documents")
def q_distinct_rows(spark, d):
    return distinct_rows(tbl(spark, d, "documents").select("text", "lang", "source"))


@register("fill_from_group", """
WITH p AS (SELECT p_partkey, p_brand, nullif(p_size, 10) AS width,
                  CASE WHEN p_size > 40 THEN p_size END AS width_pix FROM part)
SELECT p_partkey, p_brand, CAST(coalesce(width, width_pix, max(width) OVER (PARTITION BY p_brand),
       max(width_pix) OVER (PARTITION BY p_brand)) AS INTEGER) AS width FROM p""")
def q_fill_from_group(spark, d):
    pa = tbl(spark, d, "part").select(
        "p_partkey", "p_brand", F.nullif("p_size", F.lit(10)).alias("width"),
        F.when(F.col("p_size") > 40, F.col("p_size")).alias("width_pix"))
    return fill_from_group(pa, "p_brand", ["width"])


# ---------------------------------------------------------------------------
# neighbours
# ---------------------------------------------------------------------------

def _neighbour_query(direction):
    def run(spark, d):
        li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
        return neighbour(li, direction, id_col="l_partkey", key="l_orderkey", offset="l_linenumber",
                         length=F.lit(1))
    return run


register("neighbour_next", """
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_partkey AS next_l_partkey FROM lineitem a
LEFT JOIN lineitem b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber - 1 = a.l_linenumber""")(
    _neighbour_query("next"))
register("neighbour_prev", """
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_partkey AS prev_l_partkey FROM lineitem a
LEFT JOIN lineitem b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber + 1 = a.l_linenumber""")(
    _neighbour_query("prev"))

# suppliers' lines share slots (supplier, line number): many candidates for each row
_SLOTS = {"id_col": "l_orderkey", "key": "l_suppkey", "offset": "l_linenumber"}


@register("neighbour_first", """
WITH s AS (SELECT l_suppkey AS k, l_linenumber AS o, min(l_orderkey) AS first, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, a.first AS next_l_orderkey, coalesce(a.n, 0) AS next_l_orderkey_count,
       b.first AS prev_l_orderkey, coalesce(b.n, 0) AS prev_l_orderkey_count
FROM lineitem l LEFT JOIN s a ON a.k = l.l_suppkey AND a.o - 1 = l.l_linenumber
LEFT JOIN s b ON b.k = l.l_suppkey AND b.o + 1 = l.l_linenumber""")
def q_neighbour_first(spark, d):
    li = tbl(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return neighbours(li, length=F.lit(1), fan_out=False, **_SLOTS)


@register("crowded_slots", """
SELECT l_suppkey, l_linenumber * 1000 AS offset_ms, count(*) AS n_clips, min(l_orderkey) AS first_l_orderkey
FROM lineitem GROUP BY l_suppkey, l_linenumber HAVING count(*) > 1""")
def q_crowded_slots(spark, d):
    return crowded_slots(tbl(spark, d, "lineitem"), **_SLOTS)


# ---------------------------------------------------------------------------
# classification, flags, split
# ---------------------------------------------------------------------------

# Proxy rule table over part (batch = brand, key = name, flag = size > 25).
PROXY_RULES = [
    ("Maritime Horizontal", [("in", "batch", ["Brand#1", "Brand#2"])]),
    ("Fixed Maritime Horizontal", [("in", "batch", ["Brand#3"]), ("contains", "src_record_key", "red")]),
    ("Maritime", [("flag", "is_maritime", None)]),
    ("Terrestrial Horizontal", [("contains", "src_record_key", "gear")]),
    ("NDS", [("contains", "batch", "#1")]),
]
_PART_CLASSIFY = "SELECT p_partkey, p_brand AS batch, p_name AS src_record_key, p_size > 25 AS is_maritime FROM part"


def _part_classify(spark, d):
    return tbl(spark, d, "part").select("p_partkey", F.col("p_brand").alias("batch"),
                                        F.col("p_name").alias("src_record_key"),
                                        (F.col("p_size") > 25).alias("is_maritime"))


@register("classify_first_match",
          f"SELECT p_partkey, {case_rules(PROXY_RULES, C.MISSION_TYPE_DEFAULT)} AS mission_type "
          f"FROM ({_PART_CLASSIFY})")
def q_classify_first_match(spark, d):
    return _part_classify(spark, d).select(
        "p_partkey", classify_first_match(PROXY_RULES, C.MISSION_TYPE_DEFAULT).alias("mission_type"))


@register("binary_class",
          f"SELECT p_partkey, mission_type, CASE WHEN contains(mission_type, 'Horizontal') THEN 'HMI' ELSE 'FMV' END "
          f"AS loe FROM (SELECT p_partkey, {case_rules(PROXY_RULES, C.MISSION_TYPE_DEFAULT)} AS mission_type "
          f"FROM ({_PART_CLASSIFY}))")
def q_binary_class(spark, d):
    out = q_classify_first_match(spark, d)
    return out.withColumn("loe", binary_class("mission_type"))


@register("keyword_flag", """
SELECT p_partkey, coalesce(regexp_matches(p_name, '(red|blue)')
       OR (contains(p_name, 'gear') AND NOT p_brand IN ('Brand#1', 'Brand#2')), false) AS is_maritime FROM part""")
def q_keyword_flag(spark, d):
    pa = tbl(spark, d, "part")
    return pa.select("p_partkey", keyword_flag("p_name", "p_brand", substrings=["red", "blue"], marker="gear",
                                               excluded_keys=["Brand#1", "Brand#2"]).alias("is_maritime"))


@register("source_allowlist",
          "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src3', 'src5', 'src7')")
def q_source_allowlist(spark, d):
    return source_allowlist(tbl(spark, d, "documents").select("doc_id", "source"), "source",
                            ["src1", "src3", "src5", "src7"])


_SPLIT_KEY_SQL = """SELECT c_custkey, coalesce(CAST(CASE WHEN c_acctbal >= 0 THEN c_custkey END AS VARCHAR),
    'Batch:' || c_mktsegment) AS split_key FROM customer"""
_SPLIT_BUCKET_SQL = f"""SELECT c_custkey, split_key,
    CAST(CAST('0x' || substr(md5(split_key), 1, 7) AS BIGINT) % 1000 AS INTEGER) AS split_bucket
    FROM ({_SPLIT_KEY_SQL})"""


def _split_keys(spark, d):
    cu = tbl(spark, d, "customer")
    srk = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey"))
    return cu.select("c_custkey", split_key(srk, F.col("c_mktsegment")).alias("split_key"))


@register("split_key", _SPLIT_KEY_SQL)
def q_split_key(spark, d):
    return _split_keys(spark, d)


@register("split_hash", _SPLIT_BUCKET_SQL)
def q_split_hash(spark, d):
    return _split_keys(spark, d).withColumn("split_bucket", split_bucket("split_key", mode="md5"))


# Murmur3 (32 bit, seed 42) of the key's UTF-8 bytes: little-endian words, then each left-over byte, sign-extended
MURMUR3 = """
WITH b AS (SELECT {columns}, hex(encode({key})) AS h, length(hex(encode({key}))) // 2 AS n FROM {source}),
l AS (SELECT *, list_transform(range(n), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::UBIGINT) AS y FROM b),
w AS (SELECT *, list_concat(
    list_transform(range(n // 4), lambda i: y[4 * i + 1] + 256 * y[4 * i + 2] + 65536 * y[4 * i + 3] + 16777216 * y[4 * i + 4]),
    list_transform(y[4 * (n // 4) + 1:], lambda v: CASE WHEN v > 127 THEN v + 4294967040 ELSE v END)) AS words FROM l),
m AS (SELECT *, list_transform(list_transform(list_transform(words,
    lambda x: (x::UBIGINT * 3432918353) & 4294967295), lambda x: ((x << 15) | (x >> 17)) & 4294967295), lambda x: (x * 461845907) & 4294967295) AS mixed FROM w),
f AS (SELECT *, list_reduce(list_concat([42::UBIGINT], mixed), lambda a, x:
    ((((xor(a, x) << 13) | (xor(a, x) >> 19)) & 4294967295) * 5 + 3864292196) & 4294967295) AS folded FROM m),
e1 AS (SELECT *, xor(folded, n::UBIGINT) AS a1 FROM f),
e2 AS (SELECT *, (xor(a1, a1 >> 16) * 2246822507) & 4294967295 AS a2 FROM e1),
e3 AS (SELECT *, (xor(a2, a2 >> 13) * 3266489909) & 4294967295 AS a3 FROM e2),
e4 AS (SELECT *, xor(a3, a3 >> 16)::BIGINT AS a4 FROM e3)
SELECT {columns}, (abs(CASE WHEN a4 > 2147483647 THEN a4 - 4294967296 ELSE a4 END) % 1000)::INT AS split_bucket FROM e4"""
_MURMUR3_SQL = MURMUR3.format(source=f"({_SPLIT_KEY_SQL})", key="split_key", columns="c_custkey, split_key")


@register("split_hash_murmur3", _MURMUR3_SQL)
def q_split_hash_murmur3(spark, d):
    return _split_keys(spark, d).withColumn("split_bucket", split_bucket("split_key"))


@register("split_assign", f"""SELECT c_custkey, split_bucket,
  CASE WHEN split_bucket < 800 THEN 'training' WHEN split_bucket < 900 THEN 'test' ELSE 'validation' END AS split
  FROM ({_SPLIT_BUCKET_SQL})""")
def q_split_assign(spark, d):
    b = q_split_hash(spark, d)
    return b.select("c_custkey", "split_bucket", split_assign("split_bucket").alias("split"))


@register("split_timestamp", "SELECT o_orderkey, o_orderdate + INTERVAL 2 HOUR AS split_timestamp FROM orders")
def q_split_timestamp(spark, d):
    return tbl(spark, d, "orders").select("o_orderkey", split_timestamp("o_orderdate").alias("split_timestamp"))


@register("ingest_date", """SELECT o_orderkey,
  date_trunc('second', epoch_ms(1600000000000 + o_orderkey * 1000003)) AS ingest_date FROM orders""")
def q_ingest_date(spark, d):
    o = tbl(spark, d, "orders")
    ms = F.lit(1600000000000) + F.col("o_orderkey") * 1000003
    return o.select("o_orderkey", ingest_date(ms, unit="ms", ntz=True).alias("ingest_date"))


@register("ts_cast", """SELECT o_orderkey, TRY_CAST(CAST(o_orderdate AS VARCHAR)
  || CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END AS TIMESTAMP) AS ts FROM orders""")
def q_ts_cast(spark, d):
    o = tbl(spark, d, "orders")
    text = F.concat(F.col("o_orderdate").cast("string"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("x")).otherwise(F.lit("")))
    return o.select("o_orderkey", ts_cast(text, ntz=True).alias("ts"))


# ---------------------------------------------------------------------------
# paths and keys (pages.url)
# ---------------------------------------------------------------------------

@register("seq_id_from_path", r"""
WITH b AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base FROM pages)
SELECT page_id, CASE WHEN regexp_matches(base, '^.*[^.].*\.[^.]*$')
  THEN regexp_extract(base, '^(.*[^.].*)\.[^.]*$', 1) ELSE base END AS sequence_id FROM b""")
def q_seq_id_from_path(spark, d):
    return tbl(spark, d, "pages").select("page_id", seq_id_from_path("url").alias("sequence_id"))


@register("batch_from_path", "SELECT page_id, string_split(url, '/')[3] AS batch FROM pages")
def q_batch_from_path(spark, d):
    return tbl(spark, d, "pages").select("page_id", batch_from_path("url", 2).alias("batch"))


@register("strip_ext", "SELECT page_id, replace(url, '.example', '') AS url FROM pages")
def q_strip_ext(spark, d):
    return tbl(spark, d, "pages").select("page_id", strip_ext("url", ".example").alias("url"))


@register("composite_key",
          "SELECT page_id, concat_ws('-', page_id, string_split(url, '/')[3]) AS primary_key FROM pages")
def q_composite_key(spark, d):
    p = tbl(spark, d, "pages")
    return p.select("page_id", composite_key("page_id", batch_from_path("url", 2)).alias("primary_key"))


@register("first_file_per_dir", r"""
SELECT page_id, url FROM (SELECT page_id, url, row_number() OVER (
  PARTITION BY regexp_extract(url, '^(.*)/[^/]*$', 1) ORDER BY url, page_id) AS rn FROM pages) WHERE rn = 1""")
def q_first_file_per_dir(spark, d):
    return first_file_per_dir(tbl(spark, d, "pages").select("page_id", "url"), "url")


# ---------------------------------------------------------------------------
# file sources (the scale folder's own files, or table rows written as files)
# ---------------------------------------------------------------------------

_BLOB = f"read_blob('{ORACLE_DIR}/*.parquet')"
_BLOB_ID = r"regexp_extract(filename, '([^/]+)\.[^./]+$', 1)"


@register("src_video_files", f"""SELECT {_BLOB_ID} AS sequence_id, size AS filesize_bytes, md5(content) AS md5_hash,
  string_split(filename, '/')[-2] AS batch_path FROM {_BLOB}""")
def q_src_video_files(spark, d):
    cat = file_catalogue(spark, f"{d.rstrip('/')}/*.parquet", with_md5=True, batch_depth=2, first_per_dir=False)
    return cat.select("sequence_id", "filesize_bytes", "md5_hash", "batch_path")


@register("src_still_files", f"""SELECT {_BLOB_ID} AS sequence_id, size AS filesize_bytes,
  string_split(filename, '/')[-2] AS batch_path FROM {_BLOB}""")
def q_src_still_files(spark, d):
    cat = file_catalogue(spark, f"{d.rstrip('/')}/*.parquet", batch_depth=2, first_per_dir=False)
    return cat.select("sequence_id", "filesize_bytes", "batch_path")


@register("file_md5", f"SELECT {_BLOB_ID} AS sequence_id, md5(content) AS md5_hash FROM {_BLOB}")
def q_file_md5(spark, d):
    cat = file_catalogue(spark, f"{d.rstrip('/')}/*.parquet", with_md5=True, batch_depth=2, first_per_dir=False)
    return cat.select("sequence_id", "md5_hash")


def _write_lines(spark, df: DataFrame, name: str) -> str:
    """Write one JSON document per row (JSON Lines) under the shared scratch folder; return the glob."""
    path = scratch_dir(spark, name)
    doc = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS)
    df.select(doc.alias("value")).write.text(path)
    return f"{path}/part-*"


@register("src_seq_json", """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
  CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation""")
def q_src_seq_json(spark, d):
    docs = json_documents(spark, _write_lines(spark, tbl(spark, d, "nation"), "seq-json"), whole_file=False)
    return expand_json(docs, "src_json").select("n_nationkey", "n_name", "n_regionkey")


@register("src_label_json", "SELECT * FROM events")
def q_src_label_json(spark, d):
    ev = tbl(spark, d, "events")
    docs = json_documents(spark, _write_lines(spark, ev, "label-json"), whole_file=False)
    return parse_json(docs, "src_json", ev.schema, options=JSON_OPTIONS).select("src_json.*")


_DOC_SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("frames", schemas.FRAMES)])


def _frame_documents(spark, d) -> DataFrame:
    """One telemetry document per embedding row: a frame per vector element."""
    emb = tbl(spark, d, "embeddings")

    def frame(v, i):
        x = v.cast("double")
        return F.struct(
            (i + 1).cast("string").alias("seq_frame"),
            F.struct(F.concat(F.lit("f"), (i + 1).cast("string")).alias("id"),
                     F.concat(F.lit("B"), F.col("label").cast("string")).alias("sensor_band"),
                     F.lit(720).cast("long").alias("height_pix"),
                     x.alias("center_elevation_angle_deg")).alias("feed"),
            F.struct((x * 1000.0).alias("altitude_ft")).alias("platform"),
            F.struct(F.struct(F.struct((x * 180.0).alias("phi_degrees")).alias("ned")).alias("solar_angles"))
            .alias("all_fields"))

    docs = emb.select("vec_id", F.transform("embedding", frame).alias("frames"))
    return json_documents(spark, _write_lines(spark, docs, "frame-json"), whole_file=False)


_UNNEST_EMB = """(SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i
  FROM embeddings)"""


@register("src_frame_json", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS frame_count FROM embeddings")
def q_src_frame_json(spark, d):
    docs = parse_json(_frame_documents(spark, d), "src_json", _DOC_SCHEMA)
    return docs.select(F.col("src_json.vec_id").alias("vec_id"), F.size("src_json.frames").alias("frame_count"))


def _exploded_frames(spark, d):
    docs = _frame_documents(spark, d).select(
        F.get_json_object("src_json", "$.vec_id").cast("long").alias("vec_id"),
        F.get_json_object("src_json", "$.frames").alias("frames"))
    return explode_frames(docs, "frames", schemas.FRAMES)


@register("explode_frames", f"""SELECT vec_id, CAST(i AS INTEGER) AS sequence_frame,
  round(CAST(v AS DOUBLE), 6) AS center_elevation_angle_deg FROM {_UNNEST_EMB}""")
def q_explode_frames(spark, d):
    fr = _exploded_frames(spark, d)
    return fr.select("vec_id", F.col("frames.seq_frame").try_cast("int").alias("sequence_frame"),
                     r6("frames.feed.center_elevation_angle_deg").alias("center_elevation_angle_deg"))


@register("flatten_frame", f"""SELECT vec_id, CAST(i AS INTEGER) AS sequence_frame, 'B' || label AS sensor_band,
  CAST(720 AS BIGINT) AS height_pix, round(CAST(v AS DOUBLE), 6) AS center_elevation_angle_deg,
  round(CAST(v AS DOUBLE) * 1000.0, 6) AS altitude_ft, round(CAST(v AS DOUBLE) * 180.0, 6) AS solar_ned_phi,
  CAST(NULL AS VARCHAR) AS area_code FROM {_UNNEST_EMB}""")
def q_flatten_frame(spark, d):
    fr = flatten_frame(_exploded_frames(spark, d), "frames")
    return fr.select("vec_id", "sequence_frame", "sensor_band", "height_pix",
                     r6("center_elevation_angle_deg").alias("center_elevation_angle_deg"),
                     r6("altitude_ft").alias("altitude_ft"), r6("solar_ned_phi").alias("solar_ned_phi"), "area_code")


@register("flatten_frame_open", f"""SELECT vec_id, CAST(i AS INTEGER) AS sequence_frame,
  CASE WHEN label % 2 = 0 THEN round(CAST(v AS DOUBLE) * 2.0, 6) END AS extra_feed,
  CASE WHEN label % 3 = 0 THEN 'v' || label END AS variant_id, CASE WHEN label % 2 = 1 THEN CAST(i AS BIGINT) END AS ground_speed,
  'odd ' || i AS odd_key FROM {_UNNEST_EMB}""")
def q_flatten_frame_open(spark, d):
    """Fields that no schema declares, each in some documents only, through ``flat_frames``."""
    def frame(v, i):
        n = (i + 1).cast("long")
        return F.struct(
            n.cast("string").alias("seq_frame"),
            F.struct(F.when(F.col("label") % 2 == 0, v.cast("double") * 2.0).alias("extra_feed"),
                     F.when(F.col("label") % 3 == 0, F.concat(F.lit("v"), F.col("label").cast("string")))
                     .alias("VARIANT_ID")).alias("feed"),
            F.struct(F.when(F.col("label") % 2 == 1, n).alias("ground_speed")).alias("platform"),
            F.struct(F.concat(F.lit("odd "), n.cast("string")).alias("odd_key")).alias("all_fields"))

    docs = tbl(spark, d, "embeddings").select("vec_id", F.to_json(F.transform("embedding", frame)).alias("src_json"))
    fr = flat_frames(docs)
    wanted = {"extra_feed": "double", "VARIANT_ID": "string", "ground_speed": "bigint"}
    fr = fr.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in fr.columns})
    return fr.select("vec_id", "sequence_frame", r6("extra_feed").alias("extra_feed"), F.col("VARIANT_ID").alias("variant_id"),
                     "ground_speed", F.get_json_object("all_fields", "$.odd_key").alias("odd_key"))


@register("malformed_documents", """SELECT o_orderkey FROM orders
WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0""")
def q_malformed_documents(spark, d):
    """Documents cut short, arrays where an object is expected, and nulls."""
    key, text = F.col("o_orderkey"), F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    docs = tbl(spark, d, "orders").select("o_orderkey", F.when(key % 13 == 0, F.lit(None)).when(
        key % 7 == 0, F.left(text, F.length(text) - 1)).when(key % 11 == 0, F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text).alias("src_json"))
    return malformed_documents(docs).select("o_orderkey")


@register("clip_seconds", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 30 WHEN 1 THEN 8 ELSE 5 END AS clip_length
FROM orders""")
def q_clip_seconds(spark, d):
    key = F.col("o_orderkey") % 3
    frames = F.when(key == 0, 900).when(key == 1, 240).otherwise(F.when(F.col("o_orderkey") % 2 == 0, 150))
    return tbl(spark, d, "orders").select("o_orderkey", clip_seconds(frames).cast("int").alias("clip_length"))


@register("stage_write", "SELECT * FROM nation")
def q_stage_write(spark, d):
    path = scratch_dir(spark, "stage")
    stage_write(tbl(spark, d, "nation"), path, partition_by="n_regionkey")
    return stage_read(spark, path)


@register("stage_read", "SELECT * FROM customer")
def q_stage_read(spark, d):
    src = tbl(spark, d, "customer")
    return stage_read(spark, f"{d.rstrip('/')}/customer.parquet", src.schema)


@register("export_csv", """SELECT event_id, ts,
  CAST(to_json({'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS info FROM events""")
def q_export_csv(spark, d):
    path = scratch_dir(spark, "export-csv")
    ev = tbl(spark, d, "events").select("event_id", "ts", F.struct("user_id", "event_type").alias("info"))
    export_csv(ev, path)
    return spark.read.schema("event_id BIGINT, ts TIMESTAMP_NTZ, info STRING").option("header", "true") \
        .option("timestampNTZFormat", JSON_OPTIONS["timestampNTZFormat"]).csv(path)


@register("dim_read", "SELECT * FROM nation")
def q_dim_read(spark, d):
    path = scratch_dir(spark, "dim-csv")
    tbl(spark, d, "nation").write.option("header", "true").csv(path)
    return dim_read(spark, path, "n_nationkey INT, n_name STRING, n_regionkey INT")


# ---------------------------------------------------------------------------
# incremental / set operations
# ---------------------------------------------------------------------------

@register("incremental_batches", """
SELECT * FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM orders d WHERE d.o_orderstatus = 'F' AND d.o_custkey = o.o_custkey)""")
def q_incremental_batches(spark, d):
    o = tbl(spark, d, "orders")
    return skip_done(o, o.where(F.col("o_orderstatus") == "F"), "o_custkey")


@register("incremental_labels", """
SELECT c.*, c.c_name || '.json' AS file_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o JOIN customer c2 ON o.o_custkey = c2.c_custkey
  WHERE c2.c_name || '.json' = c.c_name || '.json')""")
def q_incremental_labels(spark, d):
    """Files of customers without an order are new."""
    cu = tbl(spark, d, "customer")
    listing = cu.withColumn("file_name", F.concat(F.col("c_name"), F.lit(".json")))
    done = tbl(spark, d, "orders").join(cu, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("project_name"))
    return skip_done_files(listing, done)


@register("append_union", """
SELECT * FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT * EXCLUDE (o_orderpriority) FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'""")
def q_append_union(spark, d):
    o = tbl(spark, d, "orders")
    done = o.where(F.col("o_orderstatus") == "F")
    new = o.where(~F.col("o_orderstatus").eqNullSafe("F")).drop("o_orderpriority")
    return append_union(done, new)


@register("sort_catalogue", "SELECT * FROM orders")
def q_sort_catalogue(spark, d):
    return sort_catalogue(tbl(spark, d, "orders"), [("o_orderdate", False), ("o_orderkey", True)])


@register("cluster_by_key", "SELECT * FROM orders")
def q_cluster_by_key(spark, d):
    return cluster_by_key(tbl(spark, d, "orders"), "o_custkey", ("o_custkey", "o_orderdate"))


# ---------------------------------------------------------------------------
# JSON columns, explodes, boxes (arrays built row-locally from embeddings)
# ---------------------------------------------------------------------------

@register("expand_json", "SELECT *, CAST(props ->> 'k' AS BIGINT) AS k FROM events")
def q_expand_json(spark, d):
    return expand_json(tbl(spark, d, "events"), "props")


@register("to_json_cols", """SELECT event_id,
  CAST(to_json({'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS info FROM events""")
def q_to_json_cols(spark, d):
    ev = tbl(spark, d, "events").select("event_id", F.struct("user_id", "event_type").alias("info"))
    return to_json_cols(ev)


def _tasks(spark, d):
    emb = tbl(spark, d, "embeddings")

    def task(v, i):
        return F.struct(
            F.concat(F.col("vec_id").cast("string"), F.lit("-"), i.cast("string")).alias("id"),
            F.concat(F.lit("seq"), i.cast("string"), F.lit(".mp4")).alias("name"),
            F.concat(F.lit("http://x/"), i.cast("string")).alias("url"),
            F.lit(None).cast(T.ArrayType(schemas.OBJECT)).alias("objectOccurrences"))

    return emb.select("vec_id", F.transform("embedding", task).alias("data"))


@register("explode_tasks", f"""SELECT vec_id, 'seq' || (i - 1) AS sequence_id, vec_id || '-' || (i - 1) AS task_id,
  'seq' || (i - 1) || '.mp4' AS filename FROM {_UNNEST_EMB}""")
def q_explode_tasks(spark, d):
    return explode_tasks(_tasks(spark, d)).select("vec_id", "sequence_id", "task_id", "filename")


def _ann(kind, pos):
    return F.struct(F.lit(kind).alias("type"), pos.cast("long").alias("position"),
                    F.lit(None).cast(schemas.COORDS).alias("coords"))


def _objects(spark, d):
    emb = tbl(spark, d, "embeddings")

    def obj(v, i):
        return F.struct(
            F.concat(F.lit("o"), i.cast("string")).alias("id"),
            F.array(F.struct(F.concat(F.lit("l"), i.cast("string")).alias("id"),
                             F.concat(F.lit("c"), F.col("label").cast("string")).alias("name"),
                             F.lit("k").alias("key"))).alias("labels"),
            F.array(F.struct(F.array(_ann(C.ANNOTATION_RECT, i * 10 + 1),
                                     _ann(C.ANNOTATION_POLYGON, i * 10 + 2)).alias("annotations")),
                    F.struct(F.array(_ann("AnnoOther", i * 10 + 3)).alias("annotations"))).alias("tracks"))

    return emb.select("vec_id", F.transform("embedding", obj).alias("objects"))


@register("explode_objects", f"""SELECT vec_id, 'o' || (i - 1) AS object_id, 'c' || label AS category
  FROM {_UNNEST_EMB}""")
def q_explode_objects(spark, d):
    o = explode_objects(_objects(spark, d))
    return o.select("vec_id", "object_id", F.col("labels")[0]["name"].alias("category"))


@register("explode_annotations", f"""
SELECT vec_id, 'o' || (i - 1) AS object_id, 'AnnoRect' AS type, CAST((i - 1) * 10 + 1 AS BIGINT) AS frame
  FROM {_UNNEST_EMB}
UNION ALL SELECT vec_id, 'o' || (i - 1), 'AnnoPolygon', CAST((i - 1) * 10 + 2 AS BIGINT) FROM {_UNNEST_EMB}
UNION ALL SELECT vec_id, 'o' || (i - 1), 'AnnoOther', CAST((i - 1) * 10 + 3 AS BIGINT) FROM {_UNNEST_EMB}""")
def q_explode_annotations(spark, d):
    a = explode_annotations(explode_objects(_objects(spark, d)))
    return a.select("vec_id", "object_id", "type", "frame")


@register("first_label", """SELECT vec_id, CASE WHEN label = 0 THEN NULL ELSE 'L' || vec_id END AS label_id,
  'cat' || label AS category, 'iri:' || label AS object_iri FROM embeddings""")
def q_first_label(spark, d):
    emb = tbl(spark, d, "embeddings")
    vid = F.col("vec_id").cast("string")
    labels = F.struct(
        F.when(F.col("label") == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("L"), vid), F.concat(F.lit("M"), vid))).alias("id"),
        F.array(F.concat(F.lit("cat"), F.col("label").cast("string"))).alias("name"),
        F.array(F.concat(F.lit("iri:"), F.col("label").cast("string"))).alias("key"))
    return first_label(emb.select("vec_id", labels.alias("labels")))


def _boxes(spark, d):
    emb = tbl(spark, d, "embeddings")
    e = F.col("embedding")
    pts = F.transform(F.sequence(F.lit(0), F.floor(F.size(e) / 2).cast("int") - 1),
                      lambda j: F.struct(F.element_at(e, j * 2 + 1).cast("double").alias("x"),
                                         F.element_at(e, j * 2 + 2).cast("double").alias("y")))
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    coords = F.struct(pts.alias("points"), F.array_min(xs).alias("xMin"), F.array_max(xs).alias("xMax"),
                      F.array_min(ys).alias("yMin"), F.array_max(ys).alias("yMax"))
    kind = (F.when(F.col("label") == 0, F.lit(C.ANNOTATION_RECT)).when(F.col("label") == 9, F.lit("AnnoOther"))
            .otherwise(F.lit(C.ANNOTATION_POLYGON)))
    return emb.select("vec_id", kind.alias("type"), coords.alias("coords"))


def _box_sql(where):
    return f"""WITH e AS (SELECT vec_id, label, list_filter(embedding, lambda v, i: i % 2 = 1) AS xs,
  list_filter(embedding, lambda v, i: i % 2 = 0) AS ys FROM embeddings)
SELECT vec_id, CASE WHEN label = 0 THEN 'AnnoRect' ELSE 'AnnoPolygon' END AS type,
  round(CAST(list_min(xs) AS DOUBLE), 6) AS x, round(CAST(list_min(ys) AS DOUBLE), 6) AS y,
  round(CAST(list_max(xs) AS DOUBLE) - CAST(list_min(xs) AS DOUBLE), 6) AS width,
  round(CAST(list_max(ys) AS DOUBLE) - CAST(list_min(ys) AS DOUBLE), 6) AS height
FROM e WHERE {where}"""


def _box_out(df):
    return df.select("vec_id", "type", *[r6(c).alias(c) for c in ("x", "y", "width", "height")])


register("bbox_rect", _box_sql("label = 0"))(lambda spark, d: _box_out(bbox_rect(_boxes(spark, d))))
register("bbox_polygon", _box_sql("label NOT IN (0, 9)"))(lambda spark, d: _box_out(bbox_polygon(_boxes(spark, d))))
register("bbox_union", _box_sql("label <> 9"))(lambda spark, d: _box_out(bbox_union(_boxes(spark, d))))


# ---------------------------------------------------------------------------
# projections
# ---------------------------------------------------------------------------

@register("prefix_cols", "SELECT c_custkey, c_name AS cust_c_name, c_acctbal AS cust_c_acctbal FROM customer")
def q_prefix_cols(spark, d):
    cu = tbl(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return prefix_cols(cu, "cust", ("c_name", "c_acctbal", "not_there"))


@register("rename_cols", "SELECT p_partkey, p_name AS name, p_brand AS brand FROM part")
def q_rename_cols(spark, d):
    return rename_cols(tbl(spark, d, "part"), {"p_name": "name", "p_brand": "brand"},
                       keep=["p_partkey", "p_name", "p_brand"])


@register("const_cols", f"""SELECT p_partkey, {C.LABELING_FPS} AS labeling_fps, false AS legacy,
  '{C.LABEL_SOURCE}' AS label_source, '{C.SPLIT_STRATEGY}' AS split_strategy, '{C.SPLIT_STATUS}' AS split_status,
  '{C.SPLIT_ASSIGNED_BY}' AS split_assigned_by, CAST(NULL AS VARCHAR) AS area_code FROM part""")
def q_const_cols(spark, d):
    return const_cols(tbl(spark, d, "part").select("p_partkey"), {
        "labeling_fps": C.LABELING_FPS, "legacy": C.LABEL_LEGACY, "label_source": C.LABEL_SOURCE,
        "split_strategy": C.SPLIT_STRATEGY, "split_status": C.SPLIT_STATUS,
        "split_assigned_by": C.SPLIT_ASSIGNED_BY, "area_code": (None, "string")})


@register("recast_cols", """SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
  TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment FROM customer""")
def q_recast_cols(spark, d):
    cu = tbl(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return recast_cols(cu, ["c_nationkey", "c_mktsegment", "not_there"])


@register("sum_matching_cols", """SELECT l_orderkey, l_linenumber,
  l_quantity + l_extendedprice + l_tax AS total_amount FROM lineitem""")
def q_sum_matching_cols(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty_amount"),
        F.col("l_extendedprice").alias("price_amount"), F.col("l_tax").alias("tax_amount"))
    return sum_matching_cols(li, "_amount", "total_amount")


# ---------------------------------------------------------------------------
# joins and labels (documents / labels)
# ---------------------------------------------------------------------------

@register("is_labeled", """SELECT d.doc_id, l.quality IS NOT NULL AS is_labeled
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_is_labeled(spark, d):
    j = tbl(spark, d, "documents").select("doc_id").join(tbl(spark, d, "labels"), "doc_id", "left")
    return j.select("doc_id", is_labeled("quality").alias("is_labeled"))


@register("add_label_size", """SELECT d.doc_id, d.n_chars + coalesce(l.quality, 0) AS total_filesize_bytes
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_add_label_size(spark, d):
    j = tbl(spark, d, "documents").join(tbl(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", F.col("n_chars").alias("total_filesize_bytes"), F.col("quality").alias("label_filesize_bytes"))
    return add_label_size(j)


@register("merge_sources", """
WITH o AS (SELECT o_custkey, count(*) AS order_count, max(o_totalprice) AS max_totalprice FROM orders
           GROUP BY o_custkey),
e AS (SELECT user_id, event_type AS last_event_type, value AS last_value FROM """ + _LATEST_EVENTS + """)
SELECT c.c_custkey AS seq_key, c.c_name, o.order_count, o.max_totalprice, e.last_event_type, e.last_value
FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN e ON e.user_id = c.c_custkey""")
def q_merge_sources(spark, d):
    base = tbl(spark, d, "customer").select(F.col("c_custkey").alias("seq_key"), "c_name")
    orders = tbl(spark, d, "orders").groupBy(F.col("o_custkey").alias("seq_key")).agg(
        F.count(F.lit(1)).alias("order_count"), F.max("o_totalprice").alias("max_totalprice"))
    ev = latest_per_key(tbl(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"),
                        "user_id", ["ts", "event_id"])
    ev = ev.select(F.col("user_id").alias("seq_key"), F.col("event_type").alias("last_event_type"),
                   F.col("value").alias("last_value"))
    return merge_sources(base, [orders, ev], "seq_key")


@register("dim_lookup", """SELECT c.c_custkey, c.c_nationkey, n.n_name AS nation_name, n.n_regionkey
  FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def q_dim_lookup(spark, d):
    cu = tbl(spark, d, "customer").select("c_custkey", "c_nationkey")
    return dim_lookup(cu, tbl(spark, d, "nation"), "c_nationkey",
                      rename={"n_nationkey": "c_nationkey", "n_name": "nation_name"})


_LABEL_ROWS_SQL = f"""(
  SELECT doc_id AS sequence_id, 'quality' AS label_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS category,
         'labels/q/' || doc_id || '.json' AS label_filepath, CAST(quality + 100 AS BIGINT) AS label_filesize_bytes,
         CAST(1 AS BIGINT) AS label_version, false AS label_legacy, '{C.LABEL_SOURCE}' AS label_source FROM labels
  UNION ALL
  SELECT doc_id, 'toxic', CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END, 'labels/t/' || doc_id || '.json',
         CAST(toxic + 200 AS BIGINT), CAST(2 AS BIGINT), false, '{C.LABEL_SOURCE}' FROM labels)"""
_REPORT_SQL = f"""(SELECT * EXCLUDE (rn, label_id, category) FROM (SELECT *, row_number() OVER (
  PARTITION BY sequence_id ORDER BY label_version DESC, label_filepath DESC) AS rn FROM {_LABEL_ROWS_SQL})
  WHERE rn = 1)"""


def _label_rows(spark, d):
    lab = tbl(spark, d, "labels")
    common = dict(ingest_date=F.lit(None).cast("timestamp"), legacy=F.lit(C.LABEL_LEGACY),
                  label_source=F.lit(C.LABEL_SOURCE))
    q = lab.select(
        F.col("doc_id").alias("sequence_id"), F.lit("quality").alias("label_id"),
        F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("poor")).alias("category"),
        F.concat(F.lit("labels/q/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("filepath"),
        (F.col("quality") + 100).cast("long").alias("filesize_bytes"), F.lit(1).cast("long").alias("label_version"))
    t = lab.select(
        F.col("doc_id").alias("sequence_id"), F.lit("toxic").alias("label_id"),
        F.when(F.col("toxic") == 1, F.lit("toxic")).otherwise(F.lit("clean")).alias("category"),
        F.concat(F.lit("labels/t/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("filepath"),
        (F.col("toxic") + 200).cast("long").alias("filesize_bytes"), F.lit(2).cast("long").alias("label_version"))
    return q.unionByName(t).withColumns(common)


@register("label_report", f"SELECT * FROM {_REPORT_SQL}")
def q_label_report(spark, d):
    return label_report(_label_rows(spark, d)).drop("label_ingest_date")


@register("label_join", f"""
WITH g AS (SELECT sequence_id, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories,
                  count(label_id) AS label_count, CAST(count(DISTINCT category) AS INTEGER) AS labeled_objects
           FROM (SELECT DISTINCT label_id, sequence_id, category FROM {_LABEL_ROWS_SQL}) GROUP BY sequence_id)
SELECT d.doc_id AS sequence_id, d.n_chars + coalesce(r.label_filesize_bytes, 0) AS total_filesize_bytes,
       g.categories, g.label_count, g.labeled_objects, r.label_filepath, r.label_version, r.label_legacy,
       r.label_source, r.label_version IS NOT NULL AS is_labeled
FROM documents d LEFT JOIN g ON g.sequence_id = d.doc_id LEFT JOIN {_REPORT_SQL} r ON r.sequence_id = d.doc_id""")
def q_label_join(spark, d):
    seqs = tbl(spark, d, "documents").select(F.col("doc_id").alias("sequence_id"),
                                             F.col("n_chars").alias("total_filesize_bytes"))
    out = label_join(seqs, _label_rows(spark, d))
    return out.select("sequence_id", "total_filesize_bytes", F.array_join("categories", ",").alias("categories"),
                      "label_count", "labeled_objects", "label_filepath", "label_version", "label_legacy",
                      "label_source", "is_labeled")


def _line_labels(spark, d):
    return tbl(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("sequence_id"), F.col("l_linenumber").cast("string").alias("label_id"),
        F.col("l_returnflag").alias("category"), F.struct("l_partkey", "l_suppkey").alias("annotations"))


@register("group_labels", """
SELECT sequence_id, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories,
       count(label_id) AS label_count
FROM (SELECT DISTINCT CAST(l_linenumber AS VARCHAR) AS label_id, l_orderkey AS sequence_id, l_returnflag AS category,
             l_partkey, l_suppkey FROM lineitem) GROUP BY sequence_id""")
def q_group_labels(spark, d):
    g = group_labels(_line_labels(spark, d))
    return g.select("sequence_id", F.array_join("categories", ",").alias("categories"), "label_count")


@register("annotation_members", """
SELECT DISTINCT l_orderkey AS sequence_id, CAST(l_linenumber AS VARCHAR) AS label_id, l_partkey, l_suppkey FROM lineitem""")
def q_annotation_members(spark, d):
    return annotation_members(_line_labels(spark, d)).select("sequence_id", "label_id", "annotations.*")


_DOC_TASKS = """(SELECT c_custkey, c_nationkey, CAST(c_custkey % 50 AS VARCHAR) AS seq,
  'day' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS download_date FROM customer)"""


@register("plan_labels", f"""
WITH newest AS (SELECT seq, max(download_date) AS download_date, CAST(count(*) AS INTEGER) AS label_version
                FROM {_DOC_TASKS} GROUP BY seq),
     rows AS (SELECT t.*, n.label_version FROM {_DOC_TASKS} t JOIN newest n USING (seq, download_date) WHERE c_custkey % 4 <> 0)
SELECT r.seq AS sequence_id, r.download_date, r.label_version, 'L' || r.c_nationkey AS label_id,
       'C' || r.c_nationkey AS category, n.n_name AS category_hierarchy, 1.0 AS x, 2.0 AS y,
       CAST(1 + r.c_nationkey AS DOUBLE) AS width, 4.0 AS height, '{{"n":' || r.c_custkey || '}}' AS traits
FROM rows r LEFT JOIN nation n ON n.n_nationkey = r.c_nationkey AND n.n_nationkey % 2 = 0""")
def q_plan_labels(spark, d):
    """Label documents (one per customer, every fourth without annotations) -> newest per sequence, in two runs:
    documents of even customers first, then the others with the stored rows and tasks -> boxes -> ontology."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    ann = F.struct(F.lit(C.ANNOTATION_RECT).alias("type"), F.lit(1).cast("long").alias("position"), F.struct(
        F.lit(1.0).alias("xMin"), (F.col("c_nationkey") + 2).cast("double").alias("xMax"), F.lit(2.0).alias("yMin"),
        F.lit(6.0).alias("yMax")).alias("coords"))
    obj = F.struct(F.lit("o").alias("id"), F.array(F.struct(
        F.concat(F.lit("L"), nation).alias("id"), F.concat(F.lit("C"), nation).alias("name"),
        F.concat(F.lit("iri:"), nation).alias("key"))).alias("labels"),
        F.array(F.struct(F.array(ann).alias("annotations"))).alias("tracks"))
    task = F.struct(key.cast("string").alias("id"), F.concat((key % 50).cast("string"), F.lit(".mp4")).alias("name"),
                    F.when(key % 4 != 0, F.array(obj)).alias("objectOccurrences"))
    doc = F.to_json(F.struct(F.concat(F.lit("day"), F.lpad(key.cast("string"), 9, "0")).alias("downloadedDate"),
                             F.struct(key.alias("n")).alias("traits"), F.array(task).alias("data")))
    docs = tbl(spark, d, "customer").select("c_custkey", F.concat(F.lit("d/"), key.cast("string"), F.lit(".json")).alias("filepath"),
                                            F.lit("2024-01-01").cast("timestamp").alias("modified"), F.lit(1).cast("long").alias("filesize_bytes"),
                                            doc.alias("src_json"))
    old, new = docs.where(key % 2 == 0).drop("c_custkey"), docs.where(key % 2 == 1).drop("c_custkey")
    rows_path, tasks_path = scratch_dir(spark, "old-labels"), scratch_dir(spark, "old-tasks")
    stage_write(labels_from_documents(old), rows_path)
    stage_write(label_tasks(old), tasks_path)
    labels = labels_from_documents(new, old=stage_read(spark, rows_path), old_tasks=stage_read(spark, tasks_path))
    ontology = tbl(spark, d, "nation").where("n_nationkey % 2 = 0").select(
        F.concat(F.lit("iri:"), F.col("n_nationkey").cast("string")).alias("ontology_iri"),
        F.col("n_name").alias("ontology_hierarchy_names"), F.lit(None).cast("string").alias("ontology_hierarchy_iris"))
    return label_table(labels, ontology).select("sequence_id", "download_date", "label_version", "label_id", "category",
                                                "category_hierarchy", "x", "y", "width", "height", "traits")


@register("labeled_objects", """
SELECT o.o_orderkey, CAST(g.n AS INTEGER) AS labeled_objects FROM orders o
LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY l_orderkey) g
  ON g.l_orderkey = o.o_orderkey""")
def q_labeled_objects(spark, d):
    g = group_labels(_line_labels(spark, d)).withColumnRenamed("sequence_id", "o_orderkey")
    o = tbl(spark, d, "orders").select("o_orderkey").join(g, "o_orderkey", "left")
    return o.select("o_orderkey", labeled_objects("categories").alias("labeled_objects"))


@register("annotation_struct", """
SELECT l_orderkey, l_linenumber, CAST(to_json({'annotated_by': CAST(NULL AS VARCHAR), 'visibility': 'visible',
  'type': l_returnflag, 'x': l_linenumber, 'y': l_suppkey, 'object_iri': l_linestatus,
  'object_category': l_returnflag, 'object_category_hierarchy': l_returnflag || '/' || l_linestatus,
  'height': l_linenumber, 'width': l_partkey, 'id': CAST(l_partkey AS VARCHAR),
  'is_visible': CAST(NULL AS VARCHAR), 'is_truncated': CAST(NULL AS VARCHAR)}) AS VARCHAR) AS annotation
FROM lineitem""")
def q_annotation_struct(spark, d):
    li = tbl(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("type"), F.col("l_linenumber").alias("x"),
        F.col("l_suppkey").alias("y"), F.col("l_linestatus").alias("object_iri"),
        F.col("l_returnflag").alias("category"),
        F.concat(F.col("l_returnflag"), F.lit("/"), F.col("l_linestatus")).alias("category_hierarchy"),
        F.col("l_linenumber").alias("height"), F.col("l_partkey").alias("width"),
        F.col("l_partkey").cast("string").alias("label_id"))
    return li.select("l_orderkey", "l_linenumber",
                     F.to_json(annotation_struct(), {"ignoreNullFields": "false"}).alias("annotation"))


# ---------------------------------------------------------------------------
# streaming (events written in three slices; a second run adds nothing)
# ---------------------------------------------------------------------------

def _event_slices(spark, d):
    """The whole events table as three arrivals: rows of the first, second and last third of its time span."""
    ev = tbl(spark, d, "events")
    src = scratch_dir(spark, "stream-src")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    cut1, cut2 = lo + (hi - lo) / 3, lo + (hi - lo) * 2 / 3
    ts = F.col("ts")
    slices = [ev.where(ts < F.lit(cut1)), ev.where((ts >= F.lit(cut1)) & (ts < F.lit(cut2))),
              ev.where((ts >= F.lit(cut2)) | ts.isNull())]
    return ev.schema, src, slices


@register("stream_ingest", "SELECT * FROM events")
def q_stream_ingest(spark, d):
    schema, src, slices = _event_slices(spark, d)
    sink, ckpt = scratch_dir(spark, "stream-sink"), scratch_dir(spark, "stream-ckpt")
    slices[0].write.mode("append").parquet(src)
    stream_ingest(spark, src, schema, sink, ckpt)
    for i in (1, 2):
        slices[i].write.mode("append").parquet(src)
    stream_ingest(spark, src, schema, sink, ckpt)
    stream_ingest(spark, src, schema, sink, ckpt)  # nothing new: no rows added
    return spark.read.parquet(sink)


@register("stream_latest", f"SELECT * FROM {_LATEST_EVENTS}")
def q_stream_latest(spark, d):
    schema, src, slices = _event_slices(spark, d)
    sink, ckpt = scratch_dir(spark, "latest-sink"), scratch_dir(spark, "latest-ckpt")
    for i in range(3):
        slices[i].write.mode("append").parquet(src)
        stream_latest(spark, src, schema, sink, ckpt, key="user_id", order_cols=["ts", "event_id"],
                      state_partitions=spark.sparkContext.defaultParallelism)
        if i == 1:  # the third epoch builds on the folded ones
            fold_latest(spark, sink, "user_id", ["ts", "event_id"])
    return read_latest(spark, sink, "user_id", ["ts", "event_id"])


@register("stream_ingest_rejects", """
SELECT o_orderkey % 5 AS kind, CAST(NULL AS VARCHAR) AS reason, '{"n":' || o_orderkey || '.125}' AS text FROM orders WHERE o_orderkey % 5 < 3
UNION ALL SELECT 1, 'element is no object', 'null' FROM orders WHERE o_orderkey % 5 = 1
UNION ALL SELECT 1, 'element is no object', '5' FROM orders WHERE o_orderkey % 5 = 1
UNION ALL SELECT 3, 'neither array nor object', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 5 = 3
UNION ALL SELECT 4, 'no JSON', '[{"n":' || o_orderkey FROM orders WHERE o_orderkey % 5 = 4""")
def q_stream_ingest_rejects(spark, d):
    """Documents with and without frames, one an order, streamed in two slices and once more: frames and rejects."""
    key = F.col("o_orderkey")
    frame = F.concat(F.lit('{"n":'), key, F.lit(".125}"))
    text = F.when(key % 5 == 0, frame).when(key % 5 == 1, F.concat(F.lit("["), frame, F.lit(", null, 5]"))).when(
        key % 5 == 2, F.concat(F.lit("["), frame, F.lit("]"))).when(key % 5 == 3, key.cast("string")).otherwise(
        F.concat(F.lit('[{"n":'), key))
    docs = tbl(spark, d, "orders").select(key, (key % 5).alias("kind"), text.alias("src_json"))
    src, sink, rejects, ckpt = (scratch_dir(spark, f"rejects-{x}") for x in ("src", "sink", "bad", "ckpt"))
    tag = lambda df: tagged_frames(df).select("kind", "reason", F.coalesce(F.to_json("frame"), "rejected").alias("text"))
    for part in (docs.where(key % 2 == 0), docs.where(key % 2 == 1), None):  # the last run finds nothing new
        if part is not None:
            part.drop("o_orderkey").write.mode("append").parquet(src)
        stream_ingest_rejects(spark, src, "kind long, src_json string", sink, rejects, ckpt, tag=tag)
    good = read_epochs(spark, sink).withColumn("reason", F.lit(None).cast("string"))
    return good.unionByName(read_epochs(spark, rejects)).select("kind", "reason", "text")


@register("file_mtime", f"SELECT {_BLOB_ID} AS sequence_id, CAST(epoch(last_modified) AS BIGINT) AS modified_s FROM {_BLOB}")
def q_file_mtime(spark, d):
    cat = file_catalogue(spark, f"{d.rstrip('/')}/*.parquet", batch_depth=2, first_per_dir=False)
    return cat.select("sequence_id", F.unix_seconds("modified").alias("modified_s"))
