"""Problem 5: records per dominant contributor held to a share, the best kept.

Nested caps form a laminar family (author inside domain inside parent organisation), for which
greedy selection, best record first, is exact and equals successive passes from the innermost group
outwards: each pass ranks the survivors of the last one and cuts every group at its limit. Groups
within their limit are never ranked; a group above it is ranked over many partitions
(:func:`clipwright.operators.hotkeys.ranked`), so no task holds a whole contributor.

Defined results
  null, empty key           -> unknown contributor, never capped
  null score                -> after every known score
  equal scores              -> the smaller id is kept
  repeated rows of an id    -> one record, that of latest ``appended_at``
  empty table               -> empty result
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_key
from ..operators.hotkeys import ranked
from ..session import cut
from .plainform import latest_rows


def over_cap(records: DataFrame, keys: list[str], ident: str, score: str, limit: int) -> DataFrame:
    """The ids to remove so that no group of ``keys`` has more than ``limit`` records. Groups with a null key are not capped."""
    known = records
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    # At most rows / limit groups are above their limit: 1 / share of them under a cap by share.
    heavy = known.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(*keys)
    rows = known.join(heavy, keys, "left_semi").select(*keys, ident, score)
    return ranked(rows, keys, [F.col(score).desc_nulls_last(), F.col(ident).asc()], "_rank").where(F.col("_rank") > limit).select(ident)


def nested_caps(records: DataFrame, levels: list[tuple[list[str], int]], ident: str, score: str) -> DataFrame:
    """The ids to remove under caps from the innermost level to the outermost; each level's keys contain the next one's."""
    removed, left = None, records
    for keys, limit in levels:
        gone = cut(over_cap(left, keys, ident, score, limit))
        left = left.join(gone, ident, "left_anti")
        removed = gone if removed is None else removed.unionAll(gone)
    return removed


def clip_records(words: DataFrame) -> DataFrame:
    rows = words.select("clip_id", "appended_at", clean_key("speaker_id").alias("speaker"), clean_key("channel", "-", "bilinmiyor").alias("channel"), "source_video", "confidence")
    return latest_rows(rows, ["speaker", "channel", "source_video", "confidence"])


def p5_found(spark: SparkSession, sf_dir: str, share: float = 0.05) -> DataFrame:
    clips = cut(clip_records(spark.read.parquet(f"{sf_dir}/word_clips.parquet")).drop("channel", "source_video"))
    return nested_caps(clips, [(["speaker"], int(clips.count() * share))], "clip_id", "confidence")


def p5_nested(spark: SparkSession, sf_dir: str, video: float = 0.005, author: float = 0.02, domain: float = 0.1) -> DataFrame:
    """Clips to remove under nested caps: a speaker's video within a channel, the speaker within the channel, then the channel."""
    clips = cut(clip_records(spark.read.parquet(f"{sf_dir}/word_clips.parquet")))
    n = clips.count()
    levels = [(["channel", "speaker", "source_video"], int(n * video)), (["channel", "speaker"], int(n * author)), (["channel"], int(n * domain))]
    return nested_caps(clips, levels, "clip_id", "confidence")
