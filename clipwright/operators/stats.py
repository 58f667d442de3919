"""Distribution statistics of manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def edges(lo: float, hi: float, width: float, digits: int = 6) -> list[float]:
    n = int(round((hi - lo) / width))
    return [round(lo + k * width, digits) for k in range(n + 1)]


def histogram(df: DataFrame, value: Column, group: str, bounds: list[float]) -> DataFrame:
    """(group, lo, n, share) of every group and bin: values clipped to the bounds, the last bin closed, share of known values."""
    top = len(bounds) - 1
    # least and greatest pass over nulls, so an unknown value must be kept out of them.
    v = F.when(value.isNotNull(), F.least(F.greatest(value.cast("double"), F.lit(bounds[0])), F.lit(bounds[-1])))
    arr = F.array(*map(F.lit, bounds))
    known = df.select(F.col(group).alias("group"), v.alias("v")).where("v IS NOT NULL")
    bins = known.select("group", F.least(F.size(F.filter(arr, lambda e: e <= F.col("v"))), F.lit(top)).alias("bin"))
    counts = bins.groupBy("group", "bin").agg(F.count("*").alias("n"))
    grid = df.select(F.col(group).alias("group")).distinct().withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(top))))
    full = grid.join(counts, grid["group"].eqNullSafe(counts["group"]) & (grid["bin"] == counts["bin"]), "left").select(grid["group"], grid["bin"], F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("group"))
    return full.select("group", F.element_at(arr, F.col("bin")).alias("lo"), "n", F.round(F.when(total > 0, F.col("n") / total), 6).alias("share"))


def quantiles(df: DataFrame, value: Column, group: list[str], points: list[float]) -> DataFrame:
    q = F.percentile(value.cast("double"), F.array(*map(F.lit, points)))
    return df.groupBy(*group).agg(F.count(value).alias("n"), q.alias("_q")).select(*group, "n", *(F.round(F.col("_q")[i], 6).alias(f"p{int(round(p * 100))}") for i, p in enumerate(points)))


def shares(df: DataFrame, key: Column, name: str) -> DataFrame:
    """(name, n, share) of all rows."""
    per = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("_t"))
    return per.crossJoin(F.broadcast(total)).select(name, "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"))


def with_total(df: DataFrame, key: str, aggs: dict[str, Column], label: str = "TOTAL") -> DataFrame:
    """Groups and their grand total in one rollup."""
    out = df.rollup(key).agg(F.grouping(key).alias("_g"), *(c.alias(n) for n, c in aggs.items()))
    return out.select(F.when(F.col("_g") == 1, label).otherwise(F.col(key)).alias(key), *aggs)


def distributions(df: DataFrame, measures: dict[str, Column], label: Column) -> DataFrame:
    """(measure, value, clips, classes) for several measures in one pass."""
    m = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), v.cast("int").alias("value")) for k, v in measures.items()))).alias("m")
    return df.select(label.alias("class"), m).select("class", "m.*").groupBy("measure", "value").agg(F.count("*").alias("clips"), F.count_distinct("class").alias("classes"))


def pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def speaker_table(words: DataFrame, kept: Column, in_surface: Column, in_lemma: Column) -> DataFrame:
    """One row per speaker: words, channels, source clips, hours, kept and in-vocabulary words."""
    return words.groupBy("speaker_id").agg(
        F.count("*").alias("words"), F.array_join(F.array_sort(F.collect_set("channel")), " | ").alias("channels"), F.count_distinct("source_clip").alias("source_clips"),
        F.round(F.sum(F.col("n_frames") / 25 / 3600), 6).alias("hours"), F.count_if(kept).alias("words_kept"), F.count_if(kept & in_surface).alias("words_in_vocab_surface"),
        F.count_if(kept & in_lemma).alias("words_in_vocab_lemma"),
    )


def index_percentiles(df: DataFrame, value: str, parts: int = 10) -> DataFrame:
    """p10 and p90 by index into the sorted values (n // 10, n - 1 - n // 10), from value counts rather than one sorted array."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = counts.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy()))
    at = lambda i: F.min(F.when(F.col("upto") > i, F.col("v")))
    k = F.floor(F.col("n") / parts)
    return run.agg(F.max("n").alias("n"), at(k).alias("p10"), at(F.col("n") - 1 - k).alias("p90"))


def word_sentence_table(words: DataFrame, sentences: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Per (key, split) of the words: clips, source clips, in-vocabulary and reviewed words, median face height, and the sentences and their hours (0 where none)."""
    w = words.groupBy(key, split).agg(
        F.count("*").alias("word_clips"), F.count_distinct("npz_path").alias("source_clips"), F.sum("in_vocab_surface").alias("in_vocab_surface"), F.sum("in_vocab_lemma").alias("in_vocab_lemma"),
        F.count_if(F.col("manual_review") == 1).alias("manual_review"), F.percentile(F.col("face_height_px").cast("double"), F.lit(0.5)).alias("median_face_height_px"),
    )
    s = sentences.groupBy(F.col(key).alias("_k"), F.col(split).alias("_s")).agg(F.count("*").alias("sentences"), F.sum(F.col("n_frames") / 25 / 3600).alias("sentence_hours"))
    out = w.join(s, F.col(key).eqNullSafe(F.col("_k")) & F.col(split).eqNullSafe(F.col("_s")), "left").drop("_k", "_s")
    return out.withColumn("sentences", F.coalesce("sentences", F.lit(0))).withColumn("sentence_hours", F.round(F.coalesce("sentence_hours", F.lit(0.0)), 2))
