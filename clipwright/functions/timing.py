"""Times, frames and their text forms. Frames are half-open ranges at a fixed rate; halves round to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FPS = 25


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str) -> Column:
    """Seconds from ``h:m:s``, ``m:s`` or ``s``; anything else is null."""
    parts = F.split(F.trim(_c(c)), ":")
    nums = F.transform(parts, lambda p: p.try_cast("double"))
    total = F.aggregate(nums, F.lit(0.0), lambda acc, x: acc * 60 + x)
    return F.when((F.size(parts) <= 3) & ~F.exists(nums, lambda x: x.isNull()), total)


def format_seconds(c: Column | str) -> Column:
    """Seconds for a file name: whole ones without a point, others with two places."""
    c = _c(c)
    return F.when(c == F.floor(c), F.format_string("%d", c.cast("long"))).otherwise(F.format_string("%.2f", c))


def format_hms(c: Column | str) -> Column:
    """hh:mm:ss of the seconds rounded up."""
    s = F.ceil(_c(c)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)


def segment_tag(start: Column | str, end: Column | str) -> Column:
    return F.concat_ws("-", format_seconds(start), format_seconds(end))


def frame_of(t: Column | str, fps: int = FPS) -> Column:
    return F.bround(_c(t) * fps).cast("int")


def span_frames(start: Column | str, end: Column | str, n_frames: Column | str, offset: Column | str | int = 0, fps: int = FPS) -> Column:
    """struct(f0, f1) of a word's frames in a clip of ``n_frames``; at least one frame, clamped, null if nothing is left."""
    off = F.lit(offset) if isinstance(offset, int) else _c(offset)
    f0 = frame_of(start, fps) + off
    f1 = F.greatest(frame_of(end, fps) + off, f0 + 1)
    a, b = F.greatest(f0, F.lit(0)), F.least(f1, _c(n_frames))
    known = _c(start).isNotNull() & _c(end).isNotNull() & _c(n_frames).isNotNull()
    return F.when(known & (a < b), F.struct(a.cast("int").alias("f0"), b.cast("int").alias("f1")))


def occurrence_frames(start: Column | str, end: Column | str, n_frames: Column | str, fps: int = FPS) -> Column:
    """struct(start_sec, end_sec, f0, f1, clamped) of an occurrence clamped into its sentence; null if a bound is unknown."""
    n, length = _c(n_frames), _c(n_frames) / fps
    s, e = F.least(F.greatest(_c(start), F.lit(0.0)), length), F.least(F.greatest(_c(end), F.lit(0.0)), length)
    f0 = F.least(F.bround(s * fps).cast("int"), n - 1)
    f1 = F.least(F.greatest(f0 + 1, F.bround(e * fps).cast("int")), n)
    clamped = (s != _c(start)) | (e != _c(end))
    known = _c(start).isNotNull() & _c(end).isNotNull() & n.isNotNull()
    return F.when(known, F.struct(s.alias("start_sec"), e.alias("end_sec"), f0.cast("int").alias("f0"), f1.cast("int").alias("f1"), clamped.alias("clamped")))
