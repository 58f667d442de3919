"""Text forms of figures for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bar(share: Column, width: int = 20) -> Column:
    """A bar of ``width`` places filled to a share, which is clamped to [0, 1]; unknown is empty."""
    filled = F.bround(F.least(F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * width).cast("int")
    return F.rpad(F.repeat(F.lit("#"), filled), width, ".")


def human_bytes(n: Column) -> Column:
    """Bytes in the largest unit that leaves at least one, one place after the point."""
    units = ("B", "KB", "MB", "GB", "TB")
    out = None
    for k in range(len(units) - 1, 0, -1):
        text = F.format_string(f"%.1f {units[k]}", n / float(1024**k))
        out = F.when(n >= 1024**k, text) if out is None else out.when(n >= 1024**k, text)
    return out.otherwise(F.format_string("%d B", n.cast("long")))


def human_duration(seconds: Column) -> Column:
    """Hours and minutes, minutes and seconds, or seconds."""
    s = F.floor(seconds).cast("long")
    return F.when(s >= 3600, F.format_string("%dh%02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))).when(s >= 60, F.format_string("%dm%02ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%ds", s))
