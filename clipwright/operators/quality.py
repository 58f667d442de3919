"""Ordered quality rules with reasons, and data-quality assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_label


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, null if none does; a rule over null does not hold."""
    out = None
    for name, rule in rules:
        out = F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) if out is None else out.when(F.coalesce(rule, F.lit(False)), F.lit(name))
    return out


def standalone_counts(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(rule, standalone, first): rows each rule holds for by itself, and as the first one. One pass over the data."""
    reason = first_reason(rules)
    aggs = [F.count_if(F.coalesce(r, F.lit(False))).alias(f"s_{n}") for n, r in rules] + [F.count_if(reason == n).alias(f"f_{n}") for n, _ in rules]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"s_{n}").alias("standalone"), F.col(f"f_{n}").alias("first")) for n, _ in rules))).alias("r")).select("r.*")


def word_rules(min_frames: int = 9, min_word_sec: float = 0.04, max_word_sec: float = 2.0) -> list[tuple[str, Column]]:
    length = F.col("word_end_sec") - F.col("word_start_sec")
    return [
        ("no_label", ~F.coalesce(has_label("surface_form"), F.lit(False))),
        ("track_gap", F.coalesce(F.col("track_ok"), F.lit(0)) != 1),
        ("too_few_frames", F.col("n_frames") < min_frames),
        ("word_too_short", length < min_word_sec),
        ("word_too_long", length > max_word_sec),
    ]


def share_below(c: Column | str, limit: float) -> Column:
    """Share of rows with a value below ``limit``; rows without one count in the denominator."""
    c = F.col(c) if isinstance(c, str) else c
    return F.avg(F.coalesce(c.try_cast("double") < limit, F.lit(False)).cast("int"))


def empty_profile(df: DataFrame) -> DataFrame:
    """(column_name, empty) for every column in one pass; null and '' are empty."""
    counts = df.agg(*(F.count_if(F.col(f"`{c}`").isNull() | (F.col(f"`{c}`").cast("string") == "")).alias(f"c{i}") for i, c in enumerate(df.columns)))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("empty")) for i, c in enumerate(df.columns)))).alias("p")).select("p.*")


def item_checks(df: DataFrame, fps: int = 25) -> DataFrame:
    """(check_name, violations) of an item manifest, all in one pass but uniqueness."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rules = {
        "fps": ~F.coalesce(F.col("fps") == fps, F.lit(False)),
        "span": F.col("frame_end") - F.col("frame_start") != F.col("n_frames"),
        "n_frames": ~F.coalesce(F.col("n_frames") > 0, F.lit(False)),
        "speaker": blank("speaker_id"),
        "channel": blank("channel"),
        "path": F.coalesce(F.instr("npz_path", "\\") > 0, F.lit(False)),
    }
    one = df.agg(*(F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in rules.items()))
    wide = one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check_name"), F.col(k).alias("violations")) for k in rules))).alias("c")).select("c.*")
    dup = df.groupBy("clip_id").agg(F.count("*").alias("n")).where("n > 1").agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(F.lit("unique").alias("check_name"), "violations")
    return wide.unionByName(dup)


class QualityError(ValueError):
    """An assertion about a finished table does not hold."""


def require_none(bad: DataFrame, what: str, show: int = 5) -> None:
    rows = bad.limit(show).collect()
    if rows:
        raise QualityError(f"{what}: {[r.asDict() for r in rows]}")


def assert_split_sound(rows: DataFrame, speaker: str = "speaker_id", channel: str = "channel", split: str = "split") -> None:
    """Every speaker in one split, and no channel in both train and test."""
    known = rows.where(F.col(split).isin("train", "val", "test"))
    require_none(known.groupBy(speaker).agg(F.count_distinct(split).alias("n")).where("n > 1"), "speakers in several splits")
    chans = known.where(F.col(channel).isNotNull()).groupBy(channel).agg(F.collect_set(split).alias("s"))
    require_none(chans.where(F.array_contains("s", "train") & F.array_contains("s", "test")), "channels in train and test")


def assert_known(given: list[str], known: DataFrame, column: str) -> None:
    """Every given name occurs; names given twice are refused."""
    if len(set(given)) != len(given):
        raise QualityError("a name is given twice")
    have = {r[0] for r in known.select(column).where(F.col(column).isin(*given)).distinct().collect()} if given else set()
    if missing := sorted(set(given) - have):
        raise QualityError(f"unknown: {missing}")


# Endings of files a finished run must not leave.
TRANSIENT = ("part", "tmp", "ytdl", "temp")


def leftovers(listing: DataFrame, path: str = "path", allowed: DataFrame | None = None) -> DataFrame:
    """Files a finished run should not have left: unfinished ones, and any that are not on the list of those allowed."""
    bad = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)).isin(*TRANSIENT)
    if allowed is None:
        return listing.where(bad)
    known = allowed.select(F.col(path).alias("_p"), F.lit(True).alias("_ok")).distinct()
    return listing.join(known, F.col(path) == F.col("_p"), "left").where(bad | F.col("_ok").isNull()).drop("_p", "_ok")
