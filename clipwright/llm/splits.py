"""Problem 2: train, validation and test splits that keep tied records together.

Records are tied by a shared speaker or a shared known channel; the units are the components of
the speaker-channel graph, found by minimum-label propagation. Units are then given to splits so
that every split gets its share of rows with the label distribution of the whole:

* units with at least ``LARGE`` of all rows (at most 1/LARGE of them, by arithmetic) are placed one
  by one, largest first, where they raise the deviation from the targets least, in size and over
  every label. Their label counts enter as a matrix of what each two of them share, summed in Spark;
* the rest are placed inside hash blocks in order of their dominant label, a few dozen units at a
  time by running share, filling what the large units left open. No task sees more than a block.

Defined results
  null, empty speaker        -> tied by its channel only; with neither, the clip is a unit of its own
  unknown channel ('', -, bilinmiyor) -> ties nothing
  repeated rows              -> one result row per clip and unit
  null clip_id               -> no result row, though the row still ties
  empty table                -> empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_key
from ..operators.graph import bipartite_components
from ..session import cut

SPLITS = {"train": 0.8, "val": 0.1, "test": 0.1}
LARGE, BLOCK = 0.001, 20_000
#: Small units in one running share.
ROUND = 32
#: Labels multiplied at once.
CHUNK = 1024


def tie_edges(words: DataFrame, *more: str) -> DataFrame:
    return words.select(*more, clean_key("speaker_id").alias("speaker_id"), clean_key("channel", "-", "bilinmiyor").alias("channel"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = cut(bipartite_components(tie_edges(spark.read.parquet(f"{sf_dir}/word_clips.parquet")), "speaker_id", "channel"))
    tied = units.groupBy("unit").agg(F.count("*").alias("n")).where("n > 1").select("unit")
    return units.join(tied, "unit", "left_semi").select("speaker_id", F.col("unit").alias("unit_id"))


def _products(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Over the labels of a partition, the sum of count x count / total for each two of ``n`` units."""
    g = np.zeros((n, n))
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            h, total = part.column(0), part.column(1).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(part.num_rows), h.value_lengths().to_numpy(zero_copy_only=False))
            flat = h.flatten()
            x = np.zeros((part.num_rows, n))
            x[rows, flat.field(0).to_numpy(zero_copy_only=False)] = flat.field(1).to_numpy(zero_copy_only=False)
            x /= np.sqrt(total)[:, None]
            g += x.T @ x
    i, j = np.nonzero(np.triu(g))
    for at in range(0, len(i), 1 << 16):
        k = slice(at, at + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(i[k], pa.int32()), pa.array(j[k], pa.int32()), pa.array(g[i[k], j[k]])], names=["i", "j", "g"])


def _overlap(hist: DataFrame, units: DataFrame, n: int) -> np.ndarray:
    """For each two of the ``n`` units (unit, i), the sum over all labels of the product of their counts by the label's total."""
    mine = hist.join(F.broadcast(units), "unit").groupBy("label").agg(F.collect_list(F.struct("i", F.col("c").cast("double").alias("c"))).alias("h"))
    totals = hist.groupBy("label").agg(F.sum("c").cast("double").alias("total"))
    part = mine.join(totals, "label").select("h", "total").mapInArrow(lambda it: _products(it, n), "i int, j int, g double")
    got = part.groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    g = np.zeros((n, n))
    i, j = got["i"].to_numpy(), got["j"].to_numpy()
    g[i, j] = g[j, i] = got["g"].to_numpy()
    return g


def _place_large(units: list, overlap: np.ndarray, n: int, targets: dict[str, float]) -> dict[str, str]:
    """Greedy placement, largest unit first; ``units`` holds (unit, size, its place in ``overlap``), ``n`` is the number of all rows."""
    have = dict.fromkeys(targets, 0)
    shared = {s: np.zeros(len(units)) for s in targets}
    placed = {}
    for unit, size, i in sorted(units, key=lambda u: (-u[1], u[0])):

        def cost(split: str, size=size, i=i) -> float:
            # The change of the squared distance from the targets, over all rows and over each label by its weight.
            h, t = have[split], targets[split]
            whole = ((h + size) / n - t) ** 2 - (h / n - t) ** 2
            return round(whole + (2 * shared[split][i] + overlap[i, i] - 2 * t * size) / n, 12)

        best = min(targets, key=lambda s: (cost(s), s))
        placed[unit] = best
        have[best] += size
        shared[best] += overlap[i]
    return placed


def assign(rows: DataFrame, unit: str, label: str, targets: dict[str, float] | None = None, large: float = LARGE) -> DataFrame:
    """(unit, rows, split): whole units per split, near the target shares in size and in label distribution."""
    targets = targets or SPLITS
    spark = rows.sparkSession
    hist = cut(rows.groupBy(F.col(unit).alias("unit"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("label")).agg(F.count("*").alias("c")))
    sizes = cut(hist.groupBy("unit").agg(F.sum("c").alias("size"), F.max_by("label", F.struct("c", "label")).alias("main")))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    is_large = F.col("size") >= max(1.0, total * large)
    big_rows = sizes.where(is_large).select("unit", "size").collect() if total else []
    at = spark.createDataFrame([(r["unit"], i) for i, r in enumerate(big_rows)], "unit string, i int")
    overlap = _overlap(hist, at, len(big_rows)) if big_rows else None
    placed = _place_large([(r["unit"], r["size"], i) for i, r in enumerate(big_rows)], overlap, total, targets)
    taken = {s: sum(r["size"] for r in big_rows if placed[r["unit"]] == s) for s in targets}
    open_share = {s: max(0.0, targets[s] * total - taken[s]) for s in targets}
    left = sum(open_share.values()) or 1.0
    large_df = spark.createDataFrame([(u, s) for u, s in placed.items()], "unit string, split string")
    small = sizes.where(~is_large)
    blocks = max(1, -(-small.count() // BLOCK))
    small = small.withColumn("block", F.pmod(F.xxhash64("unit"), F.lit(blocks)))
    w = Window.partitionBy("block")
    run = w.orderBy("main", F.md5("unit"), "unit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A block is cut into whole rounds of equal rows, so that neighbours in label share each round out.
    rounds = F.greatest(F.lit(1), F.floor(F.count("*").over(w) / ROUND))
    small = small.withColumn("at", (F.sum("size").over(run) - F.col("size") / 2) / F.sum("size").over(w) * rounds).withColumn("at", F.col("at") - F.floor("at"))
    choice, edge = None, 0.0
    order = sorted(targets, key=lambda s: (targets[s], s))
    for s in order[:-1]:
        edge += open_share[s] / left
        choice = F.when(F.col("at") < edge, F.lit(s)) if choice is None else choice.when(F.col("at") < edge, F.lit(s))
    choice = F.lit(order[-1]) if choice is None else choice.otherwise(F.lit(order[-1]))
    # The large units are at most 1/large, so their side is broadcast.
    big = sizes.where(is_large).join(F.broadcast(large_df), "unit").select("unit", "size", "split")
    return big.unionByName(small.select("unit", "size", choice.alias("split"))).select("unit", F.col("size").alias("rows"), "split")


def with_units(words: DataFrame) -> DataFrame:
    """Each row's unit: that of its speaker, else of its channel, else its own."""
    rows = words.select("clip_id", clean_key("speaker_id").alias("speaker"), clean_key("channel", "-", "bilinmiyor").alias("channel"), F.coalesce("lemma", F.lit("")).alias("label"))
    edges = cut(rows.where("speaker IS NOT NULL AND channel IS NOT NULL").select("speaker", "channel").distinct())
    units = cut(bipartite_components(edges, "speaker", "channel"))
    channels = edges.join(units, "speaker").groupBy("channel").agg(F.min("unit").alias("channel_unit"))
    out = rows.join(units, "speaker", "left").join(channels, "channel", "left")
    own = F.when(F.col("channel").isNotNull(), F.concat(F.lit("channel:"), "channel")).otherwise(F.concat(F.lit("clip:"), F.coalesce("clip_id", F.lit(""))))
    return out.select("clip_id", "label", F.coalesce("unit", "speaker", "channel_unit", own).alias("unit"))


def p2_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clip with its unit and the split it is given."""
    rows = cut(with_units(spark.read.parquet(f"{sf_dir}/word_clips.parquet")))
    given = assign(rows, "unit", "label")
    return rows.where("clip_id IS NOT NULL").select("clip_id", "unit").distinct().join(given.select("unit", "split"), "unit").select("clip_id", F.col("unit").alias("unit_id"), "split")


def p2_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the splits, seen from the stored rows: speakers and channels in more than one, and the clips placed."""
    given = cut(p2_splits(spark, sf_dir).select("clip_id", "split"))
    words = spark.read.parquet(f"{sf_dir}/word_clips.parquet").where("clip_id IS NOT NULL").select("clip_id", "speaker_id", "channel")
    rows = cut(tie_edges(words.join(given, "clip_id").withColumnRenamed("split", "_split"), "_split").distinct())
    torn = lambda c: rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.count_distinct("_split").alias("n")).agg(F.count_if(F.col("n") > 1).alias(f"torn_{c.split('_')[0]}s"))
    return torn("speaker_id").crossJoin(torn("channel")).crossJoin(given.agg(F.count_distinct("clip_id").alias("clips")))
