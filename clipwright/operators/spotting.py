"""Keyword-spotting ground truth from sentences with word spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_label, lemma_class, surface_class
from ..functions.timing import occurrence_frames
from ..schemas import SPAN


def spans(sentences: DataFrame) -> DataFrame:
    """One row per span: (clip_id, split, n_frames, pos, surface_form, lemma, start_sec, end_sec); broken JSON gives none."""
    parsed = sentences.select("clip_id", "split", "n_frames", F.from_json("word_spans", f"array<{SPAN}>").alias("ws"))
    return parsed.select("clip_id", "split", "n_frames", F.posexplode("ws").alias("pos", "w")).select("clip_id", "split", "n_frames", "pos", "w.*")


def broken_spans(sentences: DataFrame) -> DataFrame:
    bad = F.from_json("word_spans", f"array<{SPAN}>").isNull()
    return sentences.agg(F.count("*").alias("rows"), F.count_if(bad).alias("broken"))


def queries(spans_df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Occurrences of vocabulary classes (labeling, class) under both labelings, clamped to their sentence."""
    s = spans_df.where(has_label("surface_form"))
    both = F.explode(F.array(F.struct(F.lit("surface").alias("labeling"), surface_class("surface_form").alias("class")), F.struct(F.lit("lemma").alias("labeling"), lemma_class("lemma").alias("class")))).alias("q")
    rows = s.select("clip_id", "split", "n_frames", "pos", "surface_form", "start_sec", "end_sec", both).select("*", "q.labeling", "q.class").drop("q")
    rows = rows.join(vocab.select("labeling", "class").distinct(), ["labeling", "class"], "left_semi")
    o = occurrence_frames("start_sec", "end_sec", "n_frames")
    rows = rows.withColumn("o", o)
    return rows.select("class", "labeling", "split", "clip_id", "pos", F.round("o.start_sec", 3).alias("start_sec"), F.round("o.end_sec", 3).alias("end_sec"), F.col("o.f0").alias("start_frame"), F.col("o.f1").alias("end_frame"), "surface_form", F.col("o.clamped").alias("clamped"))


def clamped_spans(q: DataFrame) -> DataFrame:
    """Spans moved into their sentence; one that serves both labelings counts once."""
    return q.where("clamped").select("clip_id", "pos").distinct().agg(F.count("*").alias("clamped"))


def positives(q: DataFrame) -> DataFrame:
    return q.select("labeling", "class", "split", "clip_id").distinct()


def class_table(vocab: DataFrame, q: DataFrame, pool: DataFrame, min_positive: int = 5) -> DataFrame:
    """Per class and labeling: occurrences, sentences with and without it per evaluation split, and whether test has enough.

    ``pool`` holds the sentences (split, clip_id). Occurrences are counted per sentence first, so no distinct count expands the rows.
    """
    held = ("val", "test")
    per = q.where(F.col("split").isin(*held)).groupBy("labeling", "class", "split", "clip_id").agg(F.count("*").alias("n"))
    n = per.groupBy("labeling", "class").agg(
        *(F.sum(F.when(F.col("split") == s, F.col("n")).otherwise(0)).alias(f"{s}_occurrences") for s in held),
        *(F.count_if(F.col("split") == s).alias(f"{s}_pos_sentences") for s in held),
    )
    sizes = pool.select("split", "clip_id").distinct().agg(*(F.count_if(F.col("split") == s).alias(f"_{s}") for s in held))
    out = vocab.select("labeling", "class").distinct().join(n, ["labeling", "class"], "left").fillna(0).crossJoin(F.broadcast(sizes))
    out = out.withColumns({f"{s}_neg_sentences": F.col(f"_{s}") - F.col(f"{s}_pos_sentences") for s in held}).drop(*(f"_{s}" for s in held))
    return out.withColumn("evaluable", (F.col("test_pos_sentences") >= min_positive).cast("int"))


def with_media(items: DataFrame, media: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Items with the columns of their rendered media, '' where nothing was rendered."""
    m = media.groupBy(*keys).agg(*(F.max(c).alias(c) for c in columns))
    return items.join(m, keys, "left").fillna("", columns)


def occurrence_labels(q: DataFrame) -> DataFrame:
    """One row per occurrence with all classes it serves under any labeling, sorted and joined."""
    key = ["clip_id", "start_sec", "end_sec", "surface_form"]
    return q.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "labeling", "class"))), " / ").alias("labels"))


def tasks(items: DataFrame, columns: list[str]) -> DataFrame:
    """(clip_id, task): an annotation task per row as JSON, its data in the given columns."""
    return items.select("clip_id", F.to_json(F.struct(F.struct(*columns).alias("data")), {"ignoreNullFields": "false"}).alias("task"))
