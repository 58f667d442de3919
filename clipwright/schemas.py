"""Declared schemas of the manifests and nested documents. No schema is inferred from data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPINE = {
    "clip_id": "string", "npz_path": "string", "frame_start": "int", "frame_end": "int", "speaker_id": "string", "channel": "string", "source_clip": "string",
    "source_video": "string", "face_height_px": "int", "mouth_width_px": "double", "clip_start_sec": "double", "clip_end_sec": "double", "n_frames": "int", "fps": "int",
    "syncnet_score": "double", "syncnet_offset": "int", "lip_motion": "double", "mean_yaw": "double", "mean_pitch": "double",
}
WORD = {**SPINE, "surface_form": "string", "lemma": "string", "word_start_sec": "double", "word_end_sec": "double", "confidence": "double", "manual_review": "int", "word_sync_conf": "double", "track_ok": "int"}
SENTENCE = {**SPINE, "text": "string", "sentence_start_sec": "double", "sentence_end_sec": "double", "split_index": "int", "n_words": "int", "sentence_sync_conf": "double", "word_spans": "string"}
LINKS = {"url": "string", "channel": "string", "start": "string", "end": "string", "pipeline": "string", "reporter": "string", "completed": "string"}
CLIPS = {
    "reporter": "string", "source_url": "string", "source_video": "string", "clip_file": "string", "start_sec": "double", "end_sec": "double", "duration_sec": "double",
    "face_height_px": "int", "transcript_text": "string", "transcript_json": "string",
}
SCENES = {"video": "string", "scene_index": "int", "start_sec": "double", "end_sec": "double", "duration_sec": "double", "face_height_px": "int"}
SYNC = {"source_clip": "string", "speaker_id": "string", "channel": "string", "syncnet_score": "double", "syncnet_offset": "int", "min_dist": "double", "passed": "int"}
DISCARDED = {"source_clip": "string", "speaker_id": "string", "level": "string", "item_id": "string", "text": "string", "reason": "string", "detail": "string"}
TRACK_REPORT = {
    "source_clip": "string", "speaker_id": "string", "channel": "string", "status": "string", "n_frames": "int", "good_frames": "int", "no_face": "int", "multi_face": "int",
    "jump": "int", "bad_landmarks": "int", "mouth_width_px": "double", "words_total": "int", "words_kept": "int", "segments_total": "int", "sentences_kept": "int", "seconds": "double",
}

SPAN = "struct<surface_form:string,lemma:string,start_sec:double,end_sec:double>"
WORD_DOC = "struct<surface_form:string,lemma:string,start_sec:double,end_sec:double,confidence:double,manual_review:int>"
TRANSCRIPT = f"video string, segments array<struct<start_sec:double,end_sec:double,text:string,words:array<{WORD_DOC}>>>"
FACE = "struct<score:double,x:double,y:double,w:double,h:double,dist:double,yaw:double>"
FRAME_RECORDS = f"video string, t double, src_h int, frame_h int, frame_w int, faces array<{FACE}>"
EXPORT = (
    "data struct<kind:string,clip_id:string,split:string,speaker_id:string,auto_start_sec:string,auto_end_sec:string>, "
    "annotations array<struct<completed_by:string,was_cancelled:boolean,result:array<struct<from_name:string,value:struct<choices:array<string>,text:array<string>,start:double,end:double>>>>>"
)


def staged(fields: dict[str, str]) -> T.StructType:
    """The schema a manifest is read with: text in every column, in the declared order."""
    return T.StructType([T.StructField(n, T.StringType()) for n in fields])


def typed(fields: dict[str, str], strict: bool = False) -> list[Column]:
    """The typed view of a staged manifest: '' is unknown, a value that does not parse is null, or an error if strict."""
    out = []
    for name, kind in fields.items():
        c = F.nullif(F.col(name), F.lit("")) if kind != "string" else F.col(name)
        if kind == "double":
            d = c.cast("double") if strict else c.try_cast("double")
            c = F.when(~F.isnan(d), d)
        elif kind != "string":
            c = c.cast(kind) if strict else c.try_cast(kind)
        out.append(c.alias(name))
    return out
