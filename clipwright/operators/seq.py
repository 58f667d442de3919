"""Ordered series: islands, fills, padding and centred statistics as window expressions.

All are generic over the keys and the order of a series. Every series is one window partition (a
clip, a scene, a user), so the shuffle is one exchange on the series key, shared by all windows of
the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import centre_shift


#: Seconds of a stretch in which samples and scenes meet.
BIN_SEC = 60


def _w(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Number runs: a row for which ``starts`` is true begins a new one. ``starts`` may look back with :func:`before`."""
    w = _w(keys, order)
    return df.withColumn("_start", starts).withColumn(name, F.sum(F.coalesce(F.col("_start"), F.lit(True)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_start")


def before(c: Column | str, keys: list[str], order: list[str], n: int = 1) -> Column:
    return F.lag(c, n).over(_w(keys, order))


def after(c: Column | str, keys: list[str], order: list[str], n: int = 1) -> Column:
    return F.lead(c, n).over(_w(keys, order))


def forward_fill(c: Column, keys: list[str], order: list[str], default=None) -> Column:
    filled = F.last(c, ignorenulls=True).over(_w(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return filled if default is None else F.coalesce(filled, F.lit(default))


def backward_fill(c: Column, keys: list[str], order: list[str]) -> Column:
    return F.first(c, ignorenulls=True).over(_w(keys, order).rowsBetween(0, Window.unboundedFollowing))


def centred_mean(c: Column, keys: list[str], order: list[str], half: int) -> Column:
    return F.avg(c).over(_w(keys, order).rowsBetween(-half, half))


def centred_median(c: Column, keys: list[str], order: list[str], half: int) -> Column:
    return F.percentile(c, F.lit(0.5)).over(_w(keys, order).rowsBetween(-half, half))


def median_filter(c: Column, keys: list[str], order: list[str], kernel: int = 9, places: Column | None = None) -> Column:
    """Sliding median with zeros beyond both ends."""
    half = kernel // 2
    got = F.collect_list(F.coalesce(c.cast("double"), F.lit(0.0))).over(_w(keys, order).rowsBetween(-half, half))
    padded = F.concat(got, F.array_repeat(F.lit(0.0), F.lit(kernel) - F.size(got)))
    return F.element_at(F.array_sort(padded), half + 1)


def fill_short_runs(df: DataFrame, keys: list[str], order: list[str], status: str, hole: int, good: int, longest: int = 2) -> DataFrame:
    """Turn runs of at most ``longest`` rows of status ``hole`` between rows of status ``good`` into ``good``; runs at the ends stay."""
    w = _w(keys, order)
    runs = islands(df, keys, order, F.lag(status).over(w).isNull() | (F.col(status) != F.lag(status).over(w)), "_run")
    runs = runs.withColumn("_prev", F.lag(status).over(w)).withColumn("_next", F.lead(status).over(w))
    one = Window.partitionBy(*keys, "_run")
    ordered = one.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.withColumn("_n", F.count("*").over(one)).withColumn("_left", F.first("_prev").over(ordered)).withColumn("_right", F.last("_next").over(ordered))
    fill = (F.col(status) == hole) & (F.col("_n") <= longest) & (F.col("_left") == good) & (F.col("_right") == good)
    return runs.withColumn(status, F.when(fill, F.lit(good)).otherwise(F.col(status))).drop("_run", "_prev", "_next", "_n", "_left", "_right")


def spread_counts(df: DataFrame, keys: list[str], order: list[str], status: str, sample: str, good: int, multi: int, initial: int = 1) -> DataFrame:
    """Samples of a head count reach forward to the next sample, and a count above one also back to the last: good rows there become ``multi``."""
    forward, backward = forward_fill(F.col(sample), keys, order, initial), backward_fill(F.col(sample), keys, order)
    many = (forward > 1) | (F.coalesce(backward, F.lit(1)) > 1)
    return df.withColumn("_many", many).withColumn(status, F.when((F.col(status) == good) & F.col("_many"), F.lit(multi)).otherwise(F.col(status))).drop("_many")


def jump_flags(df: DataFrame, keys: list[str], order: list[str], x: str, y: str, half: str, usable: Column, share: float = 0.5) -> DataFrame:
    """Add ``jump``: further than ``share`` face sizes from the last usable row before, in sizes of that row's face."""
    w = _w(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    ref = F.last(F.when(usable, F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.col(half).alias("half"))), ignorenulls=True).over(w)
    far = F.hypot(F.col(x) - F.col("_ref.x"), F.col(y) - F.col("_ref.y")) > share * 2 * F.col("_ref.half")
    return df.withColumn("_ref", ref).withColumn("jump", F.coalesce(far, F.lit(False))).drop("_ref")


def smoothed(df: DataFrame, keys: list[str], order: list[str], value: str, good: Column, mean_half: int = 2, median_half: int = 6) -> DataFrame:
    """Add ``mean`` and ``median`` of the good rows around each row; rows without any hold the last, else borrow the first within reach, else 0."""
    g = F.when(good, F.col(value))
    first_seen = F.first(g, ignorenulls=True).over(_w(keys, order).rowsBetween(0, median_half))
    out = df.withColumn("_mean", centred_mean(g, keys, order, mean_half)).withColumn("_median", centred_median(g, keys, order, median_half)).withColumn("_first", first_seen)
    hold = lambda c: F.coalesce(forward_fill(F.col(c), keys, order), F.col("_first"), F.lit(0.0))
    return out.withColumn("mean", hold("_mean")).withColumn("median", hold("_median")).drop("_mean", "_median", "_first")


def padded_windows(frames: DataFrame, spans: DataFrame, keys: list[str], k: str, good: Column, pad: int = 15) -> DataFrame:
    """Grow each span [f0, f1) by ``pad`` frames, stopping at the ends and at bad frames. Adds a, b and full_pad.

    Per frame the nearest bad frame on either side is a running maximum and minimum; a span looks
    them up at its own ends, so the cost is one join per span, not one per frame.
    """
    bad = F.when(~good, F.col(k))
    w = _w(keys, [k])
    f = frames.select(*keys, F.col(k).alias("_k"), F.max(bad).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_lb"), F.min(bad).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("_nb"))
    total = frames.groupBy(*keys).agg((F.max(k) + 1).alias("_t"))
    left, right = f.select(*keys, F.col("_k").alias("f0"), "_lb"), f.select(*keys, (F.col("_k") + 1).alias("f1"), "_nb")
    out = spans.join(left, [*keys, "f0"]).join(right, [*keys, "f1"]).join(total, keys)
    want0, want1 = F.greatest(F.col("f0") - pad, F.lit(0)), F.least(F.col("f1") + pad, F.col("_t"))
    out = out.withColumn("a", F.greatest(want0, F.coalesce(F.col("_lb"), F.lit(-1)) + 1)).withColumn("b", F.least(want1, F.coalesce("_nb", "_t")))
    # Only a bad frame makes a pad short; the clip's own ends do not.
    return out.withColumn("full_pad", (F.col("a") == want0) & (F.col("b") == want1)).drop("_lb", "_nb", "_t")


def solo_segments(records: DataFrame, scenes: DataFrame, trim: float = 0.3, min_duration: float = 2.0, min_score: float = 0.8, min_height: float = 0.045,
                  max_shift: float = 0.5, tolerance: float = 0.6, max_yaw: float = 0.3) -> DataFrame:
    """Clips of one person alone on screen: (video, scene_index, start_sec, end_sec, face_height_px).

    Samples inside trimmed scenes; the one on-set face; tracks of small shifts; an identity verdict
    per track (median distance, none measured fails); a yaw verdict per sample; runs of passing
    samples across adjoining tracks; bounds grown by 0.1 s inside the scene.
    """
    s = scenes.select("video", "scene_index", (F.col("start_sec") + trim).alias("lo"), (F.col("end_sec") - trim).alias("hi")).where(F.col("hi") - F.col("lo") >= min_duration)
    # Samples meet only the scenes of their own stretch of time, not every scene of the video.
    binned = s.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("lo") / BIN_SEC), F.floor(F.col("hi") / BIN_SEC))))
    r = records.withColumn("_bin", F.floor(F.col("t") / BIN_SEC)).join(binned, ["video", "_bin"]).where((F.col("t") >= F.col("lo")) & (F.col("t") <= F.col("hi"))).drop("_bin")
    on_set = F.filter("faces", lambda f: (f["score"] >= min_score) & (f["h"] >= min_height))
    r = r.withColumn("solo", F.when(F.size(on_set) == 1, F.element_at(on_set, 1)))
    keys, order = ["video", "scene_index"], ["t"]
    prev = before("solo", keys, order)
    shift = centre_shift(prev, F.col("solo"), F.col("frame_w"), F.col("frame_h"))
    r = islands(r, keys, order, F.col("solo").isNull() | prev.isNull() | (shift >= max_shift), "track")
    med = F.percentile(F.col("solo.dist"), F.lit(0.5)).over(Window.partitionBy(*keys, "track"))
    r = r.withColumn("good", F.coalesce(F.col("solo").isNotNull() & (med <= tolerance) & (F.col("solo.yaw") <= max_yaw), F.lit(False)))
    r = islands(r, keys, order, F.col("good") != before("good", keys, order), "run")
    out = r.where("good").groupBy(*keys, "run", "lo", "hi").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.percentile(F.col("solo.h") * F.col("src_h"), F.lit(0.5)).cast("int").alias("face_height_px"))
    out = out.select(*keys, F.greatest("lo", F.round("a", 3) - 0.1).alias("start_sec"), F.least("hi", F.round("b", 3) + 0.1).alias("end_sec"), "face_height_px")
    return out.where(F.col("end_sec") - F.col("start_sec") >= min_duration)


def last_session(df: DataFrame, keys: list[str], at: str, gap_sec: float = 600.0, newest: int = 400) -> DataFrame:
    """The rows of the newest session per key: of the last ``newest`` rows, those after the last gap over ``gap_sec``."""
    recent = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(at)))).where(F.col("_r") <= newest)
    sec = F.col(at).cast("timestamp").cast("double")
    w = Window.partitionBy(*keys).orderBy(at)
    cutoff = recent.withColumn("_gap", F.coalesce((sec - F.lag(sec).over(w)) > gap_sec, F.lit(False)))
    tail = F.sum(F.col("_gap").cast("int")).over(w.rowsBetween(1, Window.unboundedFollowing))
    return cutoff.withColumn("_tail", F.coalesce(tail, F.lit(0))).where("_tail = 0").drop("_r", "_gap", "_tail")


def recent_rate(df: DataFrame, keys: list[str], at: str, intervals: int = 5) -> DataFrame:
    """(keys, overall, recent): rows an hour over all of a key's rows, and over its last ``intervals`` gaps; null for a single moment."""
    sec = F.col(at).cast("timestamp").cast("double")
    rows = df.select(*keys, sec.alias("_s"))
    # The filter on the rank is pushed into the window as a limit per task, so a heavy key sends a few rows each.
    last = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_s")))).where(F.col("_r") <= intervals + 1)
    per_hour = lambda n, lo, hi: F.when(hi > lo, (n - 1) * 3600 / (hi - lo))
    g = rows.groupBy(*keys).agg(F.count("_s").alias("_n"), F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    g = g.join(last.groupBy(*keys).agg(F.count("_s").alias("_m"), F.min("_s").alias("_l")), keys)
    return g.select(*keys, per_hour(F.col("_n"), F.col("_lo"), F.col("_hi")).alias("overall"), per_hour(F.col("_m"), F.col("_l"), F.col("_hi")).alias("recent"))


def idle(df: DataFrame, keys: list[str], at: str, now: Column, limit_sec: float = 600.0) -> DataFrame:
    """(keys, last, idle): whether a key's newest moment is longer ago than the limit."""
    g = df.groupBy(*keys).agg(F.max(at).alias("last"))
    return g.withColumn("idle", (now.cast("timestamp").cast("double") - F.col("last").cast("timestamp").cast("double")) > limit_sec)


def with_fallback_scenes(scenes: DataFrame, videos: DataFrame) -> DataFrame:
    """The scenes (video, scene_index, start_sec, end_sec), and one over the whole file for each video (video, duration_sec) without any."""
    bare = videos.join(scenes.select("video").distinct(), "video", "left_anti").where("duration_sec > 0")
    return scenes.select("video", "scene_index", "start_sec", "end_sec").unionByName(bare.select("video", F.lit(0).alias("scene_index"), F.lit(0.0).alias("start_sec"), F.col("duration_sec").cast("double").alias("end_sec")))


def measured_samples(records: DataFrame, video: str = "video", t: str = "t", faces: str = "faces", every: int = 10, chunk_sec: float = 300.0, max_shift: float = 0.5) -> DataFrame:
    """Add ``measured``: every ``every``-th sample of a chunk of time, and each whose face count or largest face changed since the one before it in the chunk."""
    from ..functions.geometry import largest

    keys, order = [video, "_chunk"], [t]
    r = records.withColumn("_chunk", F.floor(F.col(t) / chunk_sec)).withColumn("_big", largest(F.col(faces))).withColumn("_n", F.size(faces))
    place = F.row_number().over(_w(keys, order)) - 1
    prev, prev_n = before("_big", keys, order), before("_n", keys, order)
    moved = centre_shift(prev, F.col("_big"), F.col("frame_w"), F.col("frame_h")) >= max_shift
    changed = prev_n.isNull() | (prev_n != F.col("_n")) | F.coalesce(moved, F.lit(False))
    return r.withColumn("measured", (place % every == 0) | changed).drop("_chunk", "_big", "_n")


def slice_statistics(spans: DataFrame, tracks: DataFrame, keys: list[str], f0: str = "f0", f1: str = "f1") -> DataFrame:
    """Add ``mean_conf``, ``lip_motion`` and ``mouth_width_px`` of the frames [f0, f1) of each span's track.

    A track is one row per clip with the arrays conf, aperture and width. Frames without a value
    (null or NaN) are left out; a slice without any has null.
    """
    out = spans.join(tracks.select(*keys, "conf", "aperture", "width"), keys)
    part = lambda c: F.filter(F.slice(c, F.col(f0) + 1, F.col(f1) - F.col(f0)), lambda x: x.isNotNull() & ~F.isnan(x))
    some = lambda xs, v: F.when(F.size(xs) > 0, v)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    out = out.withColumn("_c", part("conf")).withColumn("_a", part("aperture")).withColumn("_w", F.array_sort(part("width")))
    mean = total(F.col("_a")) / F.size("_a")
    spread = F.sqrt(total(F.transform("_a", lambda x: (x - F.col("_m")) * (x - F.col("_m")))) / F.size("_a"))
    middle = lambda back: F.element_at("_w", (F.floor((F.size("_w") + back) / 2)).cast("int"))
    out = out.withColumn("mean_conf", some(F.col("_c"), total(F.col("_c")) / F.size("_c"))).withColumn("_m", some(F.col("_a"), mean))
    out = out.withColumn("lip_motion", some(F.col("_a"), spread)).withColumn("mouth_width_px", some(F.col("_w"), (middle(1) + middle(2)) / 2))
    return out.drop("_c", "_a", "_w", "_m", "conf", "aperture", "width")
