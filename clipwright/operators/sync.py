"""Audio-visual offset search over per-frame vectors, and threshold calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import distance
from ..functions.ids import hash_rank


def offset_distances(video: DataFrame, audio: DataFrame, keys: list[str], i: str, vector: str, reach: int = 15, eps: float = 1e-6) -> DataFrame:
    """(keys, i, offset, dist) of every frame against the audio ``offset`` frames away; outside the audio the vector is zero.

    A band join: each frame is exploded into its 2 * reach + 1 partners and joined by equality, so
    the shuffle is on (keys, frame), never a range product.
    """
    v = video.select(*keys, F.col(i).alias("i"), F.col(vector).alias("v")).withColumn("offset", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("_j", F.col("i") + F.col("offset"))
    a = audio.select(*keys, F.col(i).alias("_j"), F.col(vector).alias("a"))
    out = v.join(a, [*keys, "_j"], "left")
    return out.select(*keys, "i", "offset", distance(F.col("v"), F.coalesce("a", F.transform("v", lambda x: x * 0)), eps).alias("dist"))


def best_offset(distances: DataFrame, keys: list[str], min_frames: int = 30) -> DataFrame:
    """Per key: the offset of least mean distance and its confidence, the median less the least; null for too few frames."""
    per = distances.groupBy(*keys, "offset").agg(F.avg("dist").alias("m"), F.count("*").alias("n"))
    out = per.groupBy(*keys).agg(F.min_by("offset", F.struct("m", "offset")).alias("offset"), F.min("m").alias("min_dist"), F.percentile("m", F.lit(0.5)).alias("med"), F.max("n").alias("n"))
    ok = F.col("n") > min_frames
    return out.select(*keys, F.when(ok, -F.col("offset")).alias("offset"), F.when(ok, F.col("min_dist")).alias("min_dist"), F.when(ok, F.col("med") - F.col("min_dist")).alias("confidence"))


def frame_confidence(distances: DataFrame, best: DataFrame, keys: list[str], centre: int = 2) -> DataFrame:
    """Per frame: the median distance over all offsets less that at the best one, credited to the window's centre."""
    med = distances.groupBy(*keys, "i").agg(F.percentile("dist", F.lit(0.5)).alias("med"))
    at = distances.join(best.select(*keys, (-F.col("offset")).alias("offset")), [*keys, "offset"]).select(*keys, "i", "dist")
    return med.join(at, [*keys, "i"]).select(*keys, (F.col("i") + centre).alias("k"), (F.col("med") - F.col("dist")).alias("conf"))


def threshold_sweep(df: DataFrame, score: Column, positive: Column, lo: float = 0.0, hi: float = 6.0, step: float = 0.5) -> DataFrame:
    """(threshold, tpr, fpr, youden): one scan for all thresholds, as conditional averages."""
    steps = [lo + k * step for k in range(int(round((hi - lo) / step)) + 1)]
    rate = lambda t, side: F.avg(F.when(side, (score >= t).cast("double")))
    one = df.agg(*(rate(t, positive).alias(f"p{k}") for k, t in enumerate(steps)), *(rate(t, ~positive).alias(f"n{k}") for k, t in enumerate(steps)))
    out = one.select(F.explode(F.array(*(F.struct(F.lit(t).alias("threshold"), F.round(F.col(f"p{k}"), 6).alias("tpr"), F.round(F.col(f"n{k}"), 6).alias("fpr")) for k, t in enumerate(steps)))).alias("s")).select("s.*")
    return out.withColumn("youden", F.round(F.col("tpr") - F.col("fpr"), 6))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold of greatest Youden index."""
    return sweep.agg(F.max_by("threshold", F.struct("youden", -F.col("threshold"))).alias("threshold"), F.max("youden").alias("youden"))


def splice_groups(words: DataFrame, half: Column) -> DataFrame:
    """Words of a clip whose second half has foreign speech: kept before the half, dropped after it, straddlers left out."""
    g = F.when(F.col("end_sec") <= half, "spliced_keep").when(F.col("start_sec") >= half, "spliced_drop")
    return words.withColumn("group", g).where("group IS NOT NULL")


def donors(clips: DataFrame, owner: str, duration: str, key: str, seed: int = 2026, pool: int = 100) -> DataFrame:
    """Add ``donor``: for each clip a clip of another owner, at least half as long plus one second, drawn by seed.

    The draw is from a pool of the first ``pool`` clips in seeded order and, so that a clip with a donor anywhere gets one, the
    longest clips of the two owners who have the longest: one of them is another owner's. The pool is bounded, so it is broadcast.
    """
    known = clips.where(F.col(owner).isNotNull() & F.col(duration).isNotNull()).select(F.col(owner).alias("o"), F.col(duration).alias("d"), F.col(key).alias("k"))
    one = lambda df, order, n: df.orderBy(*order).limit(n).agg(F.collect_list(F.struct("k", "o", "d")).alias("x"))
    drawn = one(known, [hash_rank(seed, "k"), "k"], pool)
    best = known.groupBy("o").agg(F.max(F.struct("d", "k")).alias("m")).select("o", "m.d", "m.k")
    top = one(best, [F.desc("d"), "o"], 2)
    pools = drawn.select(F.array_sort("x").alias("_pool")).crossJoin(top.select(F.col("x").alias("_top")))
    fits = lambda xs: F.filter(xs, lambda c: (c["o"] != F.col(owner)) & (c["d"] >= F.col(duration) / 2 + 1))
    out = clips.crossJoin(F.broadcast(pools)).withColumn("_a", fits("_pool")).withColumn("_b", fits("_top"))
    turn = F.pmod(F.conv(F.substring(hash_rank(seed, key), 1, 8), 16, 10).cast("bigint"), F.size("_a").cast("bigint")).cast("int")
    pick = F.when(F.size("_a") > 0, F.get("_a", turn)["k"]).otherwise(F.get("_b", F.lit(0))["k"])
    return out.withColumn("donor", pick).drop("_pool", "_top", "_a", "_b")
