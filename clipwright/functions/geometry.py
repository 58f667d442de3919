"""Boxes and vectors of the sampled face series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def centre_shift(a: Column, b: Column, width: Column, height: Column) -> Column:
    """Distance of two box centres in widths of the smaller box; boxes are fractions of a frame of width x height pixels."""
    dx = ((a["x"] + a["w"] / 2) - (b["x"] + b["w"] / 2)) * width
    dy = ((a["y"] + a["h"] / 2) - (b["y"] + b["h"] / 2)) * height
    return F.hypot(dx, dy) / F.greatest(F.lit(1.0), F.least(a["w"], b["w"]) * width)


def yaw_ratio(left: Column, nose: Column, right: Column) -> Column:
    """How far the nose is off the middle of two landmarks: 0 frontal, 1 degenerate, null if a landmark is missing."""
    dl, dr = F.abs(nose - left), F.abs(right - nose)
    return F.when(left.isNull() | nose.isNull() | right.isNull(), F.lit(None)).when(dl + dr == 0, F.lit(1.0)).otherwise(F.abs(dr - dl) / (dr + dl))


def bottom_square(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """struct(x0, y0, x1, y1): the square of a box's width that stands on its lower edge, clamped to the frame."""
    y1 = F.least(y + h, height)
    return F.struct(F.greatest(x, F.lit(0)).alias("x0"), F.greatest(y1 - w, F.lit(0)).alias("y0"), F.least(x + w, width).alias("x1"), y1.alias("y1"))


def distance(a: Column, b: Column, eps: float = 0.0) -> Column:
    """Euclidean distance of two arrays, ``eps`` added to every difference."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y + F.lit(eps)) * (x - y + F.lit(eps))), F.lit(0.0), lambda s, v: s + v))


def largest_first(boxes: Column) -> Column:
    """Boxes (structs with w and h) by falling area; equal areas keep their order."""
    keyed = F.transform(boxes, lambda b, i: F.struct((-b["w"] * b["h"]).alias("a"), i.alias("i"), b.alias("b")))
    return F.transform(F.array_sort(keyed), lambda x: x["b"])


def largest(boxes: Column) -> Column:
    """The box of greatest area, the first of equals; null without any."""
    return F.get(largest_first(boxes), F.lit(0))
