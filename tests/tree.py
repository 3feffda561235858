"""Generate a small raw folder tree (2 batches x 3 sequences, label documents, ontology)."""

import json
import os

from seqcat import config as C

COAST = C.COASTGUARD_BATCHES[0]
EDGE = C.EDGE_BATCHES[0]

# sequence -> (batch, src_record_key, time_offset_s, data_source, video bytes)
SEQUENCES = {
    "s1": (COAST, "r1", "0", "USCG-MIAMI", b"same-video"),
    "s2": (COAST, "r1", "5", "USCG-MIAMI", b"same-video"),
    "s3": (COAST, None, "0", "USCG-MIAMI", b"video-3"),
    "s4": (EDGE, C.EDGE_FM_SRKS[0], "0", "USCG-KEYWEST", b"video-4"),
    "s5": (EDGE, C.EDGE_FM_SRKS[0], "5", "USCG-KEYWEST", b"video-5"),
    "s6": (EDGE, "r9", "0", "NOT-ALLOWED", b"video-6"),
}


def _frame(i, seq):
    nan_or = (lambda v: "NaN" if (seq == "s3" and i == 2) else v)
    return {
        "seq_frame": str(i),
        "feed": {"id": f"{seq}-{i}", "sensor_band": "EO" if i != 3 else "IR", "height_pix": 720, "width_pix": 1280,
                 "center_elevation_angle_deg": -20.0, "bottom_middle_elevation_angle_deg": -30.0,
                 "center_slant_range_nmi": 3.0, "bottom_middle_slant_range_nmi": 2.0,
                 "top_middle_vert_ires_ft": 0.02, "top_middle_horz_ires_ft": 0.03,
                 "center_vert_ires_ft": 0.05 * i, "center_horz_ires_ft": 0.1,
                 "bottom_middle_vert_ires_ft": 0.0, "bottom_middle_horz_ires_ft": 3.0},
        "platform": {"altitude_ft": 1000.0 * i},
        "all_fields": {"slant_range": nan_or(2.5), "platform_heading_angle": 90.0,
                       "uas_datalink_ls_version_number": 17, "image_source_sensor": "SLT_NONE" if i == 1 else "EO",
                       "solar_angles": {"image_plane": {"theta_degrees": 1.0, "phi_degrees": 2.0},
                                        "ned": {"theta_degrees": 3.0, "phi_degrees": 95.0}}},
    }


def _label_doc(project, date, tasks):
    return {"version": "1", "releaseName": "r", "releaseVersion": "1", "projectId": project, "projectName": project,
            "datasetId": "d", "datasetName": "d", "applicationName": "a", "applicationVersion": "1",
            "modelName": "m", "modelVersion": "1", "downloadedDate": date, "traits": {"t": "x"}, "data": tasks}


def _obj(oid, name, iri, anns):
    return {"id": oid, "labels": [{"id": f"L-{oid}", "name": name, "key": iri}],
            "tracks": [{"annotations": anns}]}


RECT = {"type": "AnnoRect", "position": 1, "coords": {"xMin": 576, "xMax": 592, "yMin": 250, "yMax": 256}}


def poly(pos, pts):
    return {"type": "AnnoPolygon", "position": pos, "coords": {"points": [{"x": x, "y": y} for x, y in pts]}}


LABEL_DOCS = {
    "p1.json": _label_doc("p1", "2023-01-01T00:00:00", [
        {"id": "t1", "name": "s1.mp4", "url": "u1", "objectOccurrences": [_obj("o1", "boat", "iri:boat", [RECT])]},
        {"id": "t2", "name": "s2.mp4", "url": "u2", "objectOccurrences": []},
        {"id": "t4", "name": "s4.mp4", "url": "u4",
         "objectOccurrences": [_obj("o4", "buoy", "iri:unknown", [RECT])]},
    ]),
    "p2.json": _label_doc("p2", "2023-02-01T00:00:00", [
        {"id": "t1b", "name": "s1.mp4", "url": "u1", "objectOccurrences": [
            _obj("o2", "boat", "iri:boat", [poly(2, [(1, 5), (3, 2)]), {"type": "Other", "position": 2}]),
            _obj("o3", "person", "iri:person", [poly(2, [(10, 10)])]),
        ]},
    ]),
}

ONTOLOGY = [("iri:boat", "vessel/boat", "iri:vessel/iri:boat"), ("iri:person", "person", "iri:person")]


def write_tree(root: str, label_docs=None, sequences=None, meta=None) -> dict:
    """``sequences`` adds clips as (batch, sequence, record key, offset, source, video bytes, frames a clip)."""
    raw, labels = os.path.join(root, "raw"), os.path.join(root, "labels")
    clips = [(b, q, k, o, s, v, 4) for q, (b, k, o, s, v) in SEQUENCES.items()] if sequences is None else sequences
    for batch, seq, srk, offset, source, video, n_frames in clips:
        d = os.path.join(raw, batch, seq)
        for sub in ("seq_mp4", "seq_zip", "mapp_metadata"):
            os.makedirs(os.path.join(d, sub), exist_ok=True)
        clip = {"seq_fps": "30", "seq_nb_frames": "150", **(meta or {}), "time_offset_s": offset, "data_source": source}
        if srk is not None:
            clip["src_record_key"] = srk
        src_meta = {"width": 1280 if seq != "s2" else None, "heigth": 720, "fps": "29.97", "nb_frames": "150",
                    "nb_streams": "1", "bit_rate": "1000", "duration": "5.0", "size": "1234", "bits_per_raw_sample": "8"}
        if seq == "s5":
            src_meta["extra_field"] = "only here"
        with open(os.path.join(d, f"{seq}.json"), "w") as f:
            json.dump({"metadata": clip, "src_metadata": src_meta}, f)
        with open(os.path.join(d, "seq_mp4", f"{seq}.mp4"), "wb") as f:
            f.write(video)
        with open(os.path.join(d, "seq_zip", f"{seq}.zip"), "wb") as f:
            f.write(b"zip-" + seq.encode())
        with open(os.path.join(d, "mapp_metadata", f"{seq}.json"), "w") as f:
            f.write(json.dumps([_frame(i, seq) for i in range(1, n_frames + 1)]).replace('"NaN"', "NaN"))
    os.makedirs(labels, exist_ok=True)
    for name, doc in (LABEL_DOCS if label_docs is None else label_docs).items():
        with open(os.path.join(labels, name), "w") as f:
            json.dump(doc, f)
    onto = os.path.join(root, "ontology.csv")
    with open(onto, "w") as f:
        f.write("ontology_iri,ontology_hierarchy_names,ontology_hierarchy_iris\n")
        for row in ONTOLOGY:
            f.write(",".join(row) + "\n")
    return {"raw": raw, "labels": labels, "ontology": onto}
