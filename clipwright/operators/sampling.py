"""Seeded samples. A row's place is the md5 of seed and key: same members in every run and engine, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import hash_rank


def _ranked(df: DataFrame, strata: list[str | Column], order: list[Column], name: str) -> DataFrame:
    """Ranks for a filter on a fixed number: Spark pushes such a limit into the window per task, so a heavy stratum sends a few rows each."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*strata).orderBy(*order)))


def stratified(df: DataFrame, strata: list[str], key: str, fraction: float, seed: int, head: int | None = None) -> DataFrame:
    """bround(fraction * n) rows of every stratum, ranked over many tasks where a stratum is large; of these the first ``head`` of a second shuffle."""
    from .hotkeys import ranked

    n = df.groupBy(*strata).agg(F.count("*").alias("_n"))
    on = None
    for s in strata:
        on = F.col(s).eqNullSafe(F.col(f"_s_{s}")) if on is None else on & F.col(s).eqNullSafe(F.col(f"_s_{s}"))
    sizes = n.select(*(F.col(s).alias(f"_s_{s}") for s in strata), F.bround(F.col("_n") * fraction).alias("_keep"))
    r = ranked(df.withColumn("_h", hash_rank(seed, key)), strata, [F.col("_h").asc(), F.col(key).asc()], "_r").drop("_h").join(sizes, on)
    out = r.where(F.col("_r") <= F.col("_keep")).drop("_r", "_keep", *(f"_s_{s}" for s in strata))
    return out.orderBy(hash_rank(seed + 1, key), key).limit(head) if head is not None else out


def up_to_k(df: DataFrame, groups: list[str], key: str, k: int, seed: int) -> DataFrame:
    return _ranked(df, groups, [hash_rank(seed, key), F.col(key)], "_r").where(F.col("_r") <= k).drop("_r")


def head_of_hash(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A global sample of n rows: a top-n, which Spark keeps per partition before it merges."""
    return df.orderBy(hash_rank(seed, key), key).limit(n)


def assign_annotators(df: DataFrame, key: str, overlap: float, seed: int, blocks: str | None = None) -> DataFrame:
    """Add ``annotator``: the first bround(overlap * n) in hash order are for both, the rest alternate between a and b.

    Positions come from a distributed rank, so no task holds the whole table.
    """
    from .hotkeys import ranked

    keyed = df.withColumn("_all", F.lit(0)).withColumn("_h", hash_rank(seed, key))
    placed = ranked(keyed, ["_all"], [F.col("_h").asc(), F.col(key).asc()], "_r")
    both = df.agg(F.bround(F.count("*") * overlap).alias("_both"))
    out = placed.crossJoin(F.broadcast(both))
    return out.withColumn("annotator", F.when(F.col("_r") <= F.col("_both"), "both").when((F.col("_r") - F.col("_both")) % 2 == 1, "a").otherwise("b")).drop("_all", "_h", "_r", "_both")


def round_robin(df: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """The first of every group, then the second, and so on, n in all."""
    # No group has a turn beyond n in the first n.
    return _ranked(df, [group], [hash_rank(seed, key), F.col(key)], "turn").where(F.col("turn") <= n).orderBy("turn", group).limit(n)


def rank_slice(counts: DataFrame, n: str, name: str, lo: int, hi: int) -> DataFrame:
    """Rows ranked lo..hi by count, ties by name."""
    top = counts.orderBy(F.desc(n), name).limit(hi)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(n), name))).where(F.col("rank") >= lo)


def rarest(counts: DataFrame, n: str, name: str, k: int = 5) -> DataFrame:
    return counts.orderBy(F.asc(n), F.desc(name)).limit(k)


def interleave(df: DataFrame, group: str, minutes: str, pos: str) -> DataFrame:
    """Order rows so that the groups' accumulated minutes stay level. Adds ``due``, the order's first key: the minutes of the group's rows before."""
    from .hotkeys import running_totals

    return running_totals(df, [group], [F.col(pos).asc()], minutes, "due")


def train_cap(df: DataFrame, speaker: str, label: str, split: str, key: str, share: float, seed: int) -> DataFrame:
    """Add ``capped``: train rows of speakers over ``share`` of train, cut per label to bround(limit / n_speaker * n_label).

    The limit is computed once, before any cut.
    """
    train = df.where(F.col(split) == "train")
    total = train.agg(F.floor(F.count("*") * share).alias("_limit"))
    # At most 1 / share speakers exceed the share.
    over = train.groupBy(F.col(speaker).alias("_spk")).agg(F.count("*").alias("_n")).crossJoin(F.broadcast(total)).where(F.col("_n") > F.col("_limit"))
    per = train.join(F.broadcast(over), F.col(speaker) == F.col("_spk")).groupBy("_spk", F.col(label).alias("_lab")).agg(F.bround(F.first("_limit") / F.first("_n") * F.count("*")).alias("_keep"))
    cut = train.join(F.broadcast(over.select("_spk")), F.col(speaker) == F.col("_spk"), "left_semi")
    from .hotkeys import ranked

    r = ranked(cut.withColumn("_h", hash_rank(seed, key)), [speaker, label], [F.col("_h").asc(), F.col(key).asc()], "_r").drop("_h")
    gone = r.join(per, (F.col(speaker) == F.col("_spk")) & F.col(label).eqNullSafe(F.col("_lab"))).where(F.col("_r") > F.col("_keep")).select(F.col(key).alias("_gone"))
    return df.join(gone, F.col(key) == F.col("_gone"), "left").withColumn("capped", F.col("_gone").isNotNull()).drop("_gone")


def negatives(positives: DataFrame, pool: DataFrame, groups: list[str], key: str, k: int, seed: int, wanted: DataFrame | None = None) -> DataFrame:
    """Up to k keys per group from its split's pool that are not positives of the group.

    ``wanted`` names the groups to draw for, those without positives included; by default those with some.

    groups: the group columns, the last of which (the split) the pool carries too. The pool is
    ranked once per split; a group takes its first k + its positives of that order, so at most
    k + positives rows per group are formed, never group x pool.
    """
    split = groups[-1]
    n_pos = positives.select(*groups, key).distinct().groupBy(*groups).agg(F.count("*").alias("_p"))
    if wanted is not None:
        n_pos = wanted.select(*groups).distinct().join(n_pos, groups, "left").withColumn("_p", F.coalesce("_p", F.lit(0).cast("bigint")))
    from .hotkeys import ranked

    order = ranked(pool.select(split, key).distinct().withColumn("_h", hash_rank(seed, key)), [split], [F.col("_h").asc(), F.col(key).asc()], "_r").drop("_h")
    wanted = n_pos.select(*groups, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_p") + k)).alias("_r"))
    cand = wanted.join(order, [split, "_r"]).join(positives.select(*groups, key).distinct(), [*groups, key], "left_anti")
    return _ranked(cand, groups, [F.col("_r")], "_t").where(F.col("_t") <= k).select(*groups, key)
