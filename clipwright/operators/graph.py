"""Connected components of a bipartite graph by iterated minimum labels, without a driver-side union-find.

Nodes become integers first, so that every round hashes longs. A round takes the least label of each
right node's members, hands it back, and jumps to the label's own label, so chains shrink by half.
A right node's least label is aggregated before it is shuffled and handed back in ``SALT`` parts, so
one with a third of all edges fills no task. Labels are broadcast only while their rows, which are
counted, are at most ``MAX_BROADCAST_NODES`` (16 bytes each); beyond it both sides are shuffled.

Defined results
  null on either side -> no edge
  repeated edges      -> one edge
  empty table         -> empty result
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, release

SALT = 16
MAX_BROADCAST_NODES = 100_000


def _side(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df.hint("merge")


def bipartite_components(edges: DataFrame, left: str, right: str, max_rounds: int = 100, max_broadcast: int = MAX_BROADCAST_NODES) -> DataFrame:
    """(left, unit): ``unit`` is the smallest left node tied to it through shared right nodes."""
    named = cut(edges.select(F.col(left).alias("l"), F.col(right).alias("r")).where("l IS NOT NULL AND r IS NOT NULL").distinct())
    lefts = cut(named.select("l").distinct().withColumn("i", F.monotonically_increasing_id()))
    rights = cut(named.select("r").distinct().withColumn("j", F.monotonically_increasing_id()))
    small_l, small_r = lefts.count() <= max_broadcast, rights.count() <= max_broadcast
    coded = named.join(_side(lefts, small_l), "l").join(_side(rights, small_r), "r")
    # The salt goes by the left node, so the members of a heavy right node are spread evenly.
    e = cut(coded.select("i", "j", F.pmod(F.hash("i"), F.lit(SALT)).alias("salt")))
    release(named)
    release(rights)
    labels = cut(lefts.select("i", F.col("i").alias("unit")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    for _ in range(max_rounds):
        by_right = e.join(_side(labels, small_l), "i").groupBy("j").agg(F.min("unit").alias("unit"))
        handed = by_right if small_r else by_right.select("j", "unit", salts)
        offered = e.join(_side(handed, small_r), ["j"] if small_r else ["j", "salt"]).groupBy("i").agg(F.min("unit").alias("new"))
        jump = labels.select(F.col("i").alias("at"), F.col("unit").alias("far"))
        step = _side(labels, small_l).join(offered, "i").join(_side(jump, small_l), F.col("unit") == F.col("at"), "left")
        nxt = cut(step.select("i", "unit", F.least("unit", "new", F.coalesce("far", "unit")).alias("new")))
        changed = nxt.where("unit <> new").limit(1).count()
        release(labels)
        labels = nxt.select("i", F.col("new").alias("unit"))
        labels._cut_path = nxt._cut_path
        if not changed:
            break
    else:
        raise RuntimeError(f"labels still changing after {max_rounds} rounds")
    release(e)
    members = cut(lefts.join(_side(labels, small_l), "i").select("l", F.col("unit").alias("c")))
    least = members.groupBy("c").agg(F.min("l").alias("unit"))
    release(labels)
    release(lefts)
    return members.join(_side(least, small_l), "c").select(F.col("l").alias(left), "unit")
