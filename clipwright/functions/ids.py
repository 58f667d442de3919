"""Names, paths, keys and seeded order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def media_name(*parts: Column | str) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *map(_c, parts))), 1, 16)


def hash_rank(seed: int, *keys: Column | str) -> Column:
    """A seeded, portable order: the same in every engine with md5."""
    return F.md5(F.concat_ws("#", F.lit(str(seed)), *(_c(k).cast("string") for k in keys)))


def group_seed(*parts: Column | str) -> Column:
    return F.crc32(F.concat_ws("/", *map(_c, parts)).cast("binary"))


def word_item_id(stem: Column | str, index: Column | str) -> Column:
    return F.concat(_c(stem), F.format_string("_w%04d", _c(index).cast("int")))


def sentence_item_id(stem: Column | str, index: Column | str, part: Column | str | None = None) -> Column:
    base = F.concat(_c(stem), F.format_string("_s%03d", _c(index).cast("int")))
    return base if part is None else F.when(_c(part).isNull(), base).otherwise(F.concat(base, F.lit("_"), _c(part).cast("string")))


def stem_of(path: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(path), r"^.*/", ""), r"\.[^.]*$", "")


def posix_path(path: Column | str) -> Column:
    return F.regexp_replace(_c(path), r"\\", "/")


def release_path(path: Column | str, root: str = "data/") -> Column:
    return F.regexp_replace(posix_path(path), f"^{root}", "")
