"""Rule tables, bucket bounds and constants.

Everything in the block marked FIXED VALUES must equal the values the
original catalogue used, otherwise results differ.  They are data, not
code: every operator takes them as parameters and only defaults to them.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original catalogue's results)
# ---------------------------------------------------------------------------

# Ground-sample-distance buckets: upper bounds (exclusive) and suffixes.
GSD_BOUNDS = [0.0208, 0.0416, 0.0833, 0.1667, 0.3333, 0.6667, 1.3333, 2.6667]
GSD_SUFFIXES = ["0.25", "0.5", "1", "2", "4", "8", "16", "32"]
GSD_INF_SUFFIX = "inf"

# Time of day from the solar elevation angle (degrees).
TIME_OF_DAY_BOUNDS = [41.25, 82.5, 90.0, 97.5, 138.75, 180.0]
TIME_OF_DAY_LABELS = ["Night1", "Night2", "Twilight", "Golden Hour", "Day1", "Day2"]

# Look angle (degrees), readable and legacy labels.
LOOK_ANGLE_BOUNDS = [15.0, 30.0, 45.0, 60.0, 75.0, 90.0]
LOOK_ANGLE_LABELS = ["00-15", "15-30", "30-45", "45-60", "60-75", "75-90"]
LOOK_ANGLE_LEGACY_LABELS = ["LA1", "LA2", "LA3", "LA4", "LA5", "LA6"]

MISSING = "Missing"
NEGATIVE = "-"

# Sentinel that stands for "no value" in telemetry text fields.
SENTINEL_NONE = "SLT_NONE"

# Values ignored by the clean mode.
MODE_IGNORED = ["", "Missing"]

# Columns whose share of non-null values is the metadata quality score.
METADATA_QUALITY_COLUMNS = ["sensor_band", "gsd", "look_angle_deg", "solar_ned_phi", "platform_heading_angle"]

# Resolution columns rolled up by mode although they are numbers.
FORCE_MODE_COLUMNS = ["height_pix", "width_pix"]

# Frame telemetry: start/end columns and global averages.
FIRST_FRAME = 1
LAST_FRAME = 150
START_END_COLUMNS = ["altitude_ft", "slant_range", "elevation_angle_degree", "avg_center_ires_ft"]
GLOBAL_AVERAGE_COLUMNS = ["altitude_ft", "elevation_angle_degree", "avg_center_ires_ft"]

# Telemetry fields picked out of ``all_fields``: output name -> (path, cast).
FRAME_DEEP_FIELDS = {
    "slant_range": ("all_fields.slant_range", None),
    "platform_heading_angle": ("all_fields.platform_heading_angle", None),
    "uas_datalink_ls_version_number": ("all_fields.uas_datalink_ls_version_number", "string"),
    "image_source_sensor": ("all_fields.image_source_sensor", None),
    "image_plane_theta": ("all_fields.solar_angles.image_plane.theta_degrees", None),
    "image_plane_phi": ("all_fields.solar_angles.image_plane.phi_degrees", None),
    "solar_ned_theta": ("all_fields.solar_angles.ned.theta_degrees", None),
    "solar_ned_phi": ("all_fields.solar_angles.ned.phi_degrees", None),
}

# Sequence-description columns re-cast to double.
RECAST_DOUBLE_COLUMNS = [
    "seq_nb_frames", "time_offset_s", "bit_rate", "duration", "fps", "nb_frames", "nb_streams", "size",
    "bits_per_raw_sample",
]

# Data sources kept in the sequence catalogue.
ALLOWED_DATA_SOURCES = [
    "12092021", "USCG-CORPUS", "USCG-SANDIEGO", "ECITY-CG", "USCG-MIAMI-12222021",
    "USCG-BARBERS", "USCG-ECITY", "CG-S-And-R", "USCG-KEYWEST", "USCG-MIAMI",
]

# Batches of the coastguard mission.
COASTGUARD_BATCHES = [
    "976-JWO-USCG-MIAMI_12092021_BATCH-2",
    "899-JWO_USCG-SANDIEGO_20211122",
    "922-JWO_USCG-CORPUS_10242021_BATCH-3",
    "603-USCG_ECITY-CG_BATCH-2",
    "921-JWO_USCG-CORPUS_10242021_BATCH-2",
    "968-JWO-USCG-MIAMI_12092021_BATCH-1",
    "1035-JWO_USCG-MIAMI_12222021_Batch-24",
    "1038-JWO_USCG-MIAMI_04182022_Batch-25",
    "1043-JWO_USCG-MIAMI_04182022_Batch-26",
    "1029-JWO_USCG-MIAMI-12222021_Batch-22",
    "959-JWO_USCG-BARBERS_BATCH-1",
    "1046-JWO_USCG-MIAMI_04202022_Batch-28",
    "1044-JWO_USCG-MIAMI_04202022_Batch-27",
    "1034-JWO_USCG-MIAMI_12222021_Batch-23",
    "1049-JWO_USCG-MIAMI_20220422_Batch-29",
    "592-JW_CG-S-And-R_Batch-1",
    "769-JWO_USCG-ECITY_05-26_27-2021",
    "770-JWO_USCG-ECITY_12-2020_05-2021",
    "682-JW_USCG-KEYWEST_04012021",
]

# Edge batches and their source record keys (fixed maritime / fixed terrestrial).
EDGE_BATCHES = ["1123-MAVEN_EDGE_20220920"]
EDGE_FM_SRKS = [
    "198613752", "198613764", "198613756", "198613750", "198613760", "198613763", "198613755",
    "198613753", "198613759", "198613746", "198613747", "198613748", "198613745", "198613749",
    "198613743", "198613741", "198613761",
]
EDGE_FT_SRKS = ["198613766", "198613751", "198613742", "198613754", "198613744", "198613757", "198613758"]
EDGE_MARKER = "EDGE_"

# Path keywords that mark maritime footage.
MARITIME_SUBSTRINGS = [
    "MARITIME", "Maritime", "maritime", "FMV-MAR", "MAVEN_HMI-MH", "MAVEN_HMI-FMH", "CCFLIR2",
    "TDO_MedAlt-MVC_20190923", "380-TDO_Triton_Job1_Batch-I", "USCG", "579-TDO_Trition_20210112",
    "592-JW_CG-S-And-R_Batch-1", "FEWSHOT_DESTROYERS",
]

# Mission type: ordered first-match rules over (batch, src_record_key, is_maritime).
# Each rule is (label, [condition, ...]); a condition is (kind, column, argument)
# with kind in {"in", "contains", "flag"}; all conditions of a rule must hold.
MISSION_TYPE_RULES = [
    ("Coastguard-CDAO", [("in", "batch", COASTGUARD_BATCHES)]),
    ("Fixed Maritime Horizontal", [("in", "batch", EDGE_BATCHES), ("in", "src_record_key", EDGE_FM_SRKS)]),
    ("Fixed Terrestrial Horizontal", [("in", "batch", EDGE_BATCHES), ("in", "src_record_key", EDGE_FT_SRKS)]),
    ("Maritime Horizontal", [("in", "batch", EDGE_BATCHES)]),
    ("Maritime Horizontal", [("contains", "batch", "MAVEN_HMI-MH")]),
    ("Fixed Maritime Horizontal", [("contains", "batch", "MAVEN_HMI-FMH")]),
    ("Maritime", [("flag", "is_maritime", None)]),
    ("Fixed Terrestrial Horizontal", [("contains", "batch", "CCTV")]),
    ("Terrestrial Horizontal", [("contains", "batch", "MAVEN_HMI-TH")]),
    ("NDS", [("contains", "batch", "NDS")]),
    ("NDS", [("contains", "batch", "SpecialFMV")]),
    ("CDAO-Scale-Coastguard", [("contains", "batch", "SCALE_ANNOS")]),
]
MISSION_TYPE_DEFAULT = "CT/COIN"

# Line of effort: mission types containing this text are HMI, the rest FMV.
LOE_MARKER = "Horizontal"
LOE_MATCH = "HMI"
LOE_OTHER = "FMV"

# Clip length in seconds by the batch's largest frame count; anything else is 5 s.
CLIP_SECONDS_BY_FRAMES = {900: 30, 240: 8}
CLIP_SECONDS_DEFAULT = 5

# Dataset split: hash buckets out of 1000; < 800 training, < 900 test, else validation.
SPLIT_BUCKETS = 1000
SPLIT_TRAINING_BELOW = 800
SPLIT_TEST_BELOW = 900
SPLIT_LABELS = ("training", "test", "validation")
SPLIT_KEY_FALLBACK_PREFIX = "Batch:"
SPLIT_STRATEGY = "split_key_split"
SPLIT_STATUS = "finalized"
SPLIT_ASSIGNED_BY = "john_doe"
SPLIT_TIMESTAMP_OFFSET_HOURS = 2

# Label constants.
LABELING_FPS = 30
LABEL_LEGACY = False
LABEL_SOURCE = "Anno.Ai"
ANNOTATION_RECT = "AnnoRect"
ANNOTATION_POLYGON = "AnnoPolygon"
ANNOTATION_VISIBILITY = "visible"

# camelCase annotation-document fields and their catalogue names.
LABEL_DOCUMENT_RENAMES = {
    "releaseName": "release_name",
    "releaseVersion": "release_version",
    "projectId": "project_id",
    "projectName": "project_name",
    "datasetId": "dataset_id",
    "datasetName": "dataset_name",
    "applicationName": "application_name",
    "applicationVersion": "application_version",
    "modelName": "model_name",
    "modelVersion": "model_version",
    "downloadedDate": "download_date",
}

# ---------------------------------------------------------------------------
# Engine settings (ours, not part of the original results)
# ---------------------------------------------------------------------------

# Groups with more rows than this are hot: they leave the single-pass hash aggregates / plain windows (whose per-group
# state grows with the group) for plans that spread a group over tasks (``operators/ranks.py``).
HOT_GROUP_ROWS = 1_000_000

# Keys that the frequent-items sketch of the hot-group detection tracks: at most so many can be hot.
SKETCH_ITEMS = 65_536

# Bins that a round of the median selection counts per group and column.
MEDIAN_BINS = 4096
