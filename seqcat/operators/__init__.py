"""DataFrame -> DataFrame operators (use with ``df.transform``)."""

from seqcat.operators._join import null_safe_join
from seqcat.operators.ranks import exact_row_number
from seqcat.operators.boxes import bbox_polygon, bbox_rect, bbox_union
from seqcat.operators.filters import source_allowlist
from seqcat.operators.incremental import append_union, skip_done, skip_done_files
from seqcat.operators.joins import add_ontology, dim_lookup, merge_sources
from seqcat.operators.jsonx import (
    expand_json,
    explode_array,
    explode_frames,
    flatten_frame,
    infer_json_schema,
    parse_json,
    to_json_cols,
)
from seqcat.operators.labels import (
    annotation_members,
    annotation_struct,
    explode_annotations,
    explode_objects,
    explode_tasks,
    first_label,
    group_labels,
    keep_latest_label,
    label_join,
    label_primary_key,
    label_report,
    rename_label_document,
)
from seqcat.operators.layout import cluster_by_key, distinct_rows, sort_catalogue
from seqcat.operators.neighbours import crowded_slots, neighbour, neighbours
from seqcat.operators.project import (
    add_label_size,
    coalesce_counts,
    const_cols,
    nan_to_null,
    prefix_cols,
    recast_cols,
    rename_cols,
    replace_sentinel,
    sum_matching_cols,
)
from seqcat.operators.rollup import (
    frame_count,
    global_averages,
    grouped_modes,
    grouped_upper_medians,
    max_per_group,
    mode_clean,
    modes_and_medians,
    starts_and_ends,
    upper_median,
)
from seqcat.operators.telemetry import derive_frame_cols, derive_gsd, derive_telemetry
from seqcat.operators.windows import dupe_members, fill_from_group, latest_per_key, potential_dupes, version_number
