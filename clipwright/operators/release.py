"""A metadata release: allow-listed columns, relative paths, verified labels, and no media."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import release_path
from .quality import QualityError

# The columns a release has, in their order.
WORD_COLUMNS = (
    "clip_id", "label_surface", "label_lemma", "in_vocab_surface", "in_vocab_lemma", "surface_form", "lemma", "word_start_sec", "word_end_sec", "speaker_id", "channel", "split", "npz_path",
    "frame_start", "frame_end", "n_frames", "fps",
)
SENTENCE_COLUMNS = ("clip_id", "text", "word_spans", "speaker_id", "channel", "split", "npz_path", "frame_start", "frame_end", "n_frames", "fps")
#: Pixels are given as a share of this.
PIXEL_SCALE = 255.0
# Suffixes no release may hold.
MEDIA = ("mp4", "mkv", "webm", "avi", "mov", "wav", "mp3", "m4a", "flac", "jpg", "jpeg", "png", "npz", "npy")


def release_words(words: DataFrame, verified: DataFrame, columns: tuple[str, ...] = WORD_COLUMNS) -> DataFrame:
    """Allow-listed columns in their order, paths relative, the checked label beside each row ('' where none)."""
    v = verified.where("kind = 'word'").groupBy("clip_id").agg(F.max("verified").alias("verified"), F.max("label_fix").alias("label_fix"))
    out = words.select(*columns).withColumn("npz_path", release_path("npz_path")).join(v, "clip_id", "left")
    return out.select(*columns, F.coalesce(F.col("verified").cast("string"), F.lit("")).alias("verified"), F.coalesce("label_fix", F.lit("")).alias("label_fix"))


def release_sentences(sentences: DataFrame, columns: tuple[str, ...] = SENTENCE_COLUMNS) -> DataFrame:
    """Allow-listed columns of the sentences of val and test, paths relative."""
    return sentences.where(F.col("split").isin("val", "test")).select(*columns).withColumn("npz_path", release_path("npz_path"))


def banned_files(listing: DataFrame, path: str = "path") -> DataFrame:
    return listing.where(F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)).isin(*MEDIA))


def assert_no_media(listing: DataFrame, path: str = "path") -> None:
    bad = [r[0] for r in banned_files(listing, path).select(path).limit(5).collect()]
    if bad:
        raise QualityError(f"media in the release: {bad}")


def pixel_statistics(spark: SparkSession, folder: str, field: str = "frames", glob: str = "*.npz", keep: DataFrame | None = None) -> DataFrame:
    """(files, unreadable, n, mean, std) of pixels as shares of 255, pooled over tensor files: one partial (n, sum, sum of squares) per file, then their sums."""
    import io

    def partials(pdfs: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for pdf in pdfs:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    x = np.load(io.BytesIO(content))[field].astype(np.float64) / PIXEL_SCALE
                    rows.append((path, float(x.size), float(x.sum()), float((x * x).sum())))
                except Exception:
                    rows.append((path, None, None, None))
            yield pd.DataFrame(rows, columns=["path", "n", "s", "ss"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path", "content")
    if keep is not None:
        files = files.join(keep, "path", "left_semi")
    p = files.mapInPandas(partials, "path string, n double, s double, ss double")
    one = p.agg(F.count("*").alias("files"), F.count_if(F.col("n").isNull()).alias("unreadable"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    mean = F.col("s") / F.col("n")
    return one.select("files", "unreadable", "n", mean.alias("mean"), F.sqrt(F.greatest(F.col("ss") / F.col("n") - mean * mean, F.lit(0.0))).alias("std"))


def provenance(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of input files."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def target_check(achieved: dict[str, float], wanted: dict[str, float]) -> str:
    """A JSON report of targets: wanted, achieved, met."""
    return json.dumps({k: {"wanted": v, "achieved": achieved.get(k), "met": achieved.get(k) is not None and achieved[k] >= v} for k, v in sorted(wanted.items())}, ensure_ascii=False)
