"""Search over held-out unit combinations: shares, class counts left, and the rank of a chosen split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def unit_combos(units: DataFrame, max_size: int = 3, lo: float = 0.06, hi: float = 0.14) -> DataFrame:
    """(combo, share): sorted arrays of 1..max_size units whose rows are a share in [lo, hi] of all.

    Units above the band are dropped first, and each size grows only from combinations still at or
    below it, so no product over all units is formed. Each level is written, so that its true, small
    size decides how the next one joins to it.
    """
    total = units.agg(F.sum("n").alias("_t"))
    u = cut(units.crossJoin(F.broadcast(total)).select("unit", (F.col("n") / F.col("_t")).alias("share")).where(F.col("share") <= hi).coalesce(1))
    level = u.select(F.array("unit").alias("combo"), "share")
    out = level
    nxt = u.select(F.col("unit").alias("_u"), F.col("share").alias("_s"))
    for _ in range(max_size - 1):
        level = cut(level.join(nxt, (F.element_at("combo", -1) < F.col("_u")) & (F.col("share") + F.col("_s") <= hi)).select(F.concat("combo", F.array("_u")).alias("combo"), (F.col("share") + F.col("_s")).alias("share")).coalesce(1))
        out = out.unionAll(level)
    return out.where(F.col("share") >= lo)


def combo_pairs(combos: DataFrame, target: float = 0.1) -> DataFrame:
    """(test, val, shares, score) of disjoint pairs; the score is the distance of both shares from the target, in points."""
    combos = cut(combos)
    # Combinations are few, as their units are; each is dealt to a task and set against the others.
    t = combos.repartition("combo").select(F.col("combo").alias("test"), F.col("share").alias("test_share"))
    v = combos.select(F.col("combo").alias("val"), F.col("share").alias("val_share"))
    score = F.round(100 * (F.abs(F.col("test_share") - target) + F.abs(F.col("val_share") - target)), 2)
    return t.join(v, ~F.arrays_overlap("test", "val")).withColumn("score", score)


def classes_left(pairs: DataFrame, unit_class: DataFrame, min_train: int) -> DataFrame:
    """Add ``classes``: how many classes keep ``min_train`` rows once test and val are held out.

    Held counts are summed once per combination, then subtracted per pair and class.
    """
    pairs = cut(pairs)
    total = unit_class.groupBy("class").agg(F.sum("n").alias("tot")).where(F.col("tot") >= min_train)
    combos = pairs.select(F.col("test").alias("combo")).unionAll(pairs.select("val")).distinct()
    held = combos.select("combo", F.explode("combo").alias("unit")).join(unit_class, "unit").groupBy("combo", "class").agg(F.sum("n").alias("held"))
    p = pairs.withColumn("pair", F.struct("test", "val"))
    sides = p.select("pair", F.explode(F.array("test", "val")).alias("combo"))
    lost = sides.join(held, "combo").groupBy("pair", "class").agg(F.sum("held").alias("held")).join(total, "class").where(F.col("tot") - F.col("held") < min_train)
    n_lost = lost.groupBy("pair").agg(F.count("*").alias("lost"))
    n_total = total.agg(F.count("*").alias("all"))
    out = p.join(n_lost, "pair", "left").crossJoin(F.broadcast(n_total))
    return out.withColumn("classes", F.col("all") - F.coalesce("lost", F.lit(0))).drop("pair", "lost", "all")


def top_candidates(scored: DataFrame, chosen: Column, n: int = 200) -> DataFrame:
    """The best n by score, then classes; the chosen pair first."""
    rows = scored.withColumn("chosen", chosen.cast("int"))
    best = rows.orderBy("score", F.desc("classes"), "test", "val").limit(n)
    return rows.where("chosen = 1").unionByName(best.where("chosen = 0"))


def rank_of(scored: DataFrame, chosen: Column) -> DataFrame:
    """(closer,): how many pairs score better than the chosen one; -1 if it is not among them."""
    own = scored.where(chosen).agg(F.min("score").alias("own"))
    return scored.crossJoin(F.broadcast(own)).agg(F.when(F.max("own").isNull(), F.lit(-1)).otherwise(F.count_if(F.col("score") < F.col("own"))).alias("closer"))
