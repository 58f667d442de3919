"""Views of the tables that the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import agreement, spotting
from ..session import table

SEED = 2026
MIN_TRAIN, MIN_SPEAKERS = 10, 3


def _words(spark: SparkSession, d: str) -> DataFrame:
    """word_clips with clean keys and class keys, rows as stored."""
    w = table(spark, d, "word_clips")
    return w.withColumns({"speaker_id": text.clean_key("speaker_id"), "channel": text.clean_key("channel", "-", "bilinmiyor"), "split": F.lower(F.trim("split")), "surface": text.surface_class("surface_form"), "lemma_cls": text.lemma_class("lemma")})


def _clips(spark: SparkSession, d: str) -> DataFrame:
    """One row per word clip."""
    low = {c: F.min(c).alias(c) for c in ("speaker_id", "channel", "lemma", "surface", "lemma_cls", "split", "source_clip")}
    return _words(spark, d).where("clip_id IS NOT NULL").groupBy("clip_id").agg(*low.values(), F.max("confidence").alias("confidence"), F.max("n_frames").alias("n_frames"))


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    """One row per sentence clip with the split of its source clip."""
    s = table(spark, d, "sentence_clips").where("clip_id IS NOT NULL").groupBy("clip_id").agg(F.max("word_spans").alias("word_spans"), F.max("n_frames").alias("n_frames"), F.max("source_clip").alias("source_clip"))
    splits = _words(spark, d).where("split IN ('train', 'val', 'test')").groupBy("source_clip").agg(F.max("split").alias("split"))
    return s.join(splits, "source_clip")


def _vocab(spark: SparkSession, d: str) -> DataFrame:
    """(labeling, class): the published lemma list under both labelings."""
    c = table(spark, d, "lemma_classes_605").select(text.lemma_class("lemma").alias("class")).where("class <> ''").distinct()
    return c.select(F.explode(F.array(F.lit("surface"), F.lit("lemma"))).alias("labeling"), "class")


def _queries(spark: SparkSession, d: str) -> DataFrame:
    return spotting.queries(spotting.spans(_sentences(spark, d)), _vocab(spark, d))


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "annotations").where(~F.coalesce("was_cancelled", F.lit(False)))
    v = F.regexp_replace(F.lower(F.trim("verdict")), " ", "_")
    a = a.select(F.lower(F.trim("kind")).alias("kind"), "clip_id", text.clean_key("annotator").alias("annotator"), v.alias("verdict"), "created_at", "annotation_id").where("verdict <> '' AND annotator IS NOT NULL")
    return agreement.last_verdicts(a, ["created_at", "annotation_id"])


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


_K, _O = ["user_id"], ["ts", "event_id"]


def _reporter_rows(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "reporter_clips").where("clip_file IS NOT NULL")
    return r.groupBy("clip_file").agg(F.min("source_url").alias("source_url"), F.min("source_video").alias("source_video"), F.min("start_sec").alias("start_sec"), F.min("end_sec").alias("end_sec"), F.max("face_height_px").alias("face_height_px"), F.min(text.clean_key("reporter")).alias("reporter"), F.max("duration_sec").alias("duration_sec"))


def _frames(spark: SparkSession, d: str) -> DataFrame:
    """Events as frames of a clip per user: k counts from 0, status 0 good, 1 error, 2 purchase."""
    e = _events(spark, d).withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1)
    return e.select("user_id", "event_id", "k", "value", F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", 2).otherwise(0).alias("status"))
