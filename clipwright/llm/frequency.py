"""Problem 6: how often every distinct term occurs, and which terms are too rare or too common.

A global dictionary gives every distinct (field, term) a dense integer. Encoded rows are accumulated
into blocks of counters, one numpy array per identifier range, and the arrays of a range are summed.
The terms that hold at least ``HEAVY`` of all rows, of which there are at most 1/HEAVY, are encoded by
a broadcast of theirs alone, so a term that makes up a third of all rows is never shuffled; the others
meet the dictionary by term. Occurrences are then counted where they lie and only arrays travel.

Defined results
  null or empty value, nothing but punctuation -> no term
  repeated rows of a clip                      -> its row of latest appended_at
  null, empty speaker                          -> counted in clips, not in speakers
  null source clip                             -> counted in clips, not in source clips
  listed lemma that never occurs               -> counts 0; stale if listed otherwise
  empty tables                                 -> empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_key
from ..session import cut, release
from .plainform import latest_rows, term_of, to_plain

BLOCK = 4096
#: Blocks a task holds before it hands them on; bounds its memory at 3 * 8 * BLOCK bytes each.
HELD_BLOCKS = 512
MEASURES = ("clips", "speakers", "sources")
#: Share of all rows from which on a term is heavy.
HEAVY = 0.001


def dictionary(terms: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns`` with their number ``n`` and a dense integer ``id`` in their sorted order."""
    by = [F.col(c).asc_nulls_first() for c in columns]
    placed = cut(terms.groupBy(*columns).agg(F.count("*").alias("n")).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    # One row per partition of the range exchange: as many rows as tasks, so it is broadcast.
    sizes = placed.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    skip = sizes.select(F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_skip"))
    return placed.join(F.broadcast(skip), part == F.col("_q")).select(*columns, "n", (F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_skip")).alias("id"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}

    def handed():
        if held:
            keys = sorted(held)
            flat = pa.array([held[k].ravel() for k in keys], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), flat], names=["block", "counts"])
            held.clear()

    for batch in batches:
        ids, kind, n = (np.asarray(batch.column(i)) for i in range(3))
        which = ids // BLOCK
        for b in np.unique(which):
            at = which == b
            cell = kind[at] * BLOCK + ids[at] % BLOCK
            got = np.bincount(cell, n[at], len(MEASURES) * BLOCK).astype(np.int64).reshape(len(MEASURES), BLOCK)
            if b in held:
                held[b] += got
            else:
                held[int(b)] = got
        if len(held) > HELD_BLOCKS:
            yield from handed()
    yield from handed()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays come sorted by block; one block's sum is held at a time."""
    block, total = None, None

    def rows():
        used = np.flatnonzero(total.sum(0))
        return pa.RecordBatch.from_arrays([pa.array(block * BLOCK + used, pa.int64()), *(pa.array(total[m, used], pa.int64()) for m in range(len(MEASURES)))], names=["id", *MEASURES])

    for batch in batches:
        lists = batch.column(1)
        width = len(MEASURES) * BLOCK
        values = np.asarray(lists.flatten()).reshape(-1, len(MEASURES), BLOCK) if len(lists) else np.zeros((0, width))
        for b, counts in zip(batch.column(0).to_pylist(), values):
            if b != block:
                if block is not None:
                    yield rows()
                block, total = b, counts.copy()
            else:
                total += counts
    if block is not None:
        yield rows()


def counted(encoded: DataFrame) -> DataFrame:
    """(id, clips, speakers, sources) from encoded rows (id, kind: index of the measure, n)."""
    blocks = encoded.select("id", "kind", "n").mapInArrow(_blocks, "block bigint, counts array<bigint>")
    ranges = blocks.repartition("block").sortWithinPartitions("block")
    return ranges.mapInArrow(_summed, "id bigint, clips bigint, speakers bigint, sources bigint")


def _fingerprint(c: Column) -> Column:
    """128 bits of an id that is only counted, never shown: a quarter of its length in every shuffle."""
    return F.unhex(F.md5(c))


def clip_terms(words: DataFrame) -> DataFrame:
    """The deduplicated clips: their two terms, and fingerprints of speaker and source clip."""
    rows = words.select(_fingerprint(F.col("clip_id")).alias("clip_id"), "appended_at", "surface_form", "lemma", _fingerprint(clean_key("speaker_id")).alias("speaker"), _fingerprint(F.col("source_clip")).alias("source"))
    clips = to_plain(latest_rows(rows, ["surface_form", "lemma", "speaker", "source"]), "surface_form", "lemma")
    return clips.select(term_of("surface_form").alias("surface_form"), term_of("lemma").alias("lemma"), "speaker", "source")


def encoded(rows: DataFrame, terms: DataFrame, heavy: float = HEAVY) -> DataFrame:
    """Rows with field and term replaced by the dictionary's id."""
    total = terms.agg(F.sum("n")).first()[0] or 0
    key, bound = ["field", "term"], max(1, int(total * heavy))
    top = F.broadcast(terms.where(F.col("n") >= bound).select(*key, "id"))
    rest = rows.join(top, key, "left_anti").join(terms.where(F.col("n") < bound).select(*key, "id").hint("merge"), key)
    return rows.join(top, key).unionByName(rest).drop(*key)


def term_counts(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The deduplicated clips, and (field, term, clips, speakers, sources) of every distinct term."""
    clips = cut(clip_terms(words))
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("term")) for f in ("surface_form", "lemma")))).alias("p")
    long = clips.select("speaker", "source", pairs).select("p.field", "p.term", "speaker", "source").where("term <> ''")
    terms = cut(dictionary(long, ["field", "term"]))
    # From here on a term is its integer.
    rows = cut(encoded(long, terms).select("id", "speaker", "source"))
    one = F.lit(1).cast("bigint").alias("n")
    speakers = rows.where("speaker IS NOT NULL").select("id", "speaker").distinct().select("id", F.lit(1).alias("kind"), one)
    sources = rows.where("source IS NOT NULL").select("id", "source").distinct().select("id", F.lit(2).alias("kind"), one)
    cells = rows.select("id", F.lit(0).alias("kind"), one).unionAll(speakers).unionAll(sources)
    counts = cut(terms.join(counted(cells), "id").select("field", "term", *MEASURES))
    release(rows)
    release(terms)
    return clips, counts


def listed_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lemma_classes_605.parquet").select("lemma", F.col("count").cast("bigint").alias("listed_clips"), F.col("speakers").cast("bigint").alias("listed_speakers"))
    return to_plain(rows, "lemma").select(term_of("lemma").alias("term"), "listed_clips", "listed_speakers").where("term <> ''")


def marks(counts: DataFrame, clips: DataFrame, listed: DataFrame, min_clips: int = 3, min_speakers: int = 2, max_share: float = 0.2) -> DataFrame:
    total = clips.agg(F.count_distinct("source").alias("total"))
    rare = counts.where((F.col("clips") < min_clips) | (F.col("speakers") < min_speakers)).select("field", "term", F.lit("rare").alias("mark"))
    common = counts.crossJoin(F.broadcast(total)).where(F.col("sources") > F.col("total") * max_share).select("field", "term", F.lit("common").alias("mark"))
    lemmas = counts.where("field = 'lemma'").select("term", "clips", "speakers")
    both = listed.join(lemmas, "term", "left")
    wrong = ~F.col("listed_clips").eqNullSafe(F.coalesce("clips", F.lit(0))) | ~F.col("listed_speakers").eqNullSafe(F.coalesce("speakers", F.lit(0)))
    stale = both.where(wrong).select(F.lit("lemma").alias("field"), "term", F.lit("stale").alias("mark")).distinct()
    return rare.unionAll(common).unionAll(stale)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips, counts = term_counts(spark.read.parquet(f"{sf_dir}/word_clips.parquet"))
    return marks(counts, clips, listed_lemmas(spark, sf_dir))


def p6_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips, known speakers and source clips of every distinct term."""
    return term_counts(spark.read.parquet(f"{sf_dir}/word_clips.parquet"))[1]
