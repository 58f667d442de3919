"""Lemmas of distinct surfaces: candidates are voted on and ranked, the result is joined back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lemma_fallback

#: Order of preference among candidate analyses of a word.
CANDIDATE = "surface string, lemma string, penalty int, morphemes int, open_class int, intact int, ord int"


def choose_lemma(candidates: DataFrame) -> DataFrame:
    """(surface, lemma): least penalty, fewest morphemes, open class, intact root, most votes, longest lemma, first listed."""
    votes = candidates.groupBy("surface", "lemma").agg(
        F.count("*").alias("votes"), F.min("penalty").alias("penalty"), F.min("morphemes").alias("morphemes"), F.max("open_class").alias("open_class"), F.max("intact").alias("intact"), F.min("ord").alias("ord")
    )
    key = F.struct("penalty", "morphemes", -F.col("open_class"), -F.col("intact"), -F.col("votes"), -F.length("lemma"), "ord", "lemma")
    return votes.groupBy("surface").agg(F.min_by("lemma", key).alias("lemma"))


def lemma_map(words: DataFrame, surface: str, analyse: Callable[[str], list[tuple[str, int, int, int, int]]] | None = None) -> DataFrame:
    """(surface, lemma) of the distinct surfaces. Without an analyser, or where it knows nothing, the fallback rule."""
    distinct = words.select(F.col(surface).alias("surface")).where("surface IS NOT NULL").distinct()
    plain = distinct.select("surface", lemma_fallback("surface").alias("fallback"))
    if analyse is None:
        return plain.select("surface", F.col("fallback").alias("lemma"))

    def candidates(pdfs: Iterator) -> Iterator:
        import pandas as pd

        for pdf in pdfs:
            rows = [(s, lem, p, m, o, i, n) for s in pdf["surface"] for n, (lem, p, m, o, i) in enumerate(analyse(s))]
            yield pd.DataFrame(rows, columns=["surface", "lemma", "penalty", "morphemes", "open_class", "intact", "ord"])

    best = choose_lemma(distinct.mapInPandas(candidates, CANDIDATE))
    return plain.join(best, "surface", "left").select("surface", F.coalesce("lemma", "fallback").alias("lemma"))


def backfill(words: DataFrame, lemmas: DataFrame, surface: str = "surface_form", lemma: str = "lemma") -> DataFrame:
    """Words with lemmas from the map; ``changed`` tells whether the row had another one."""
    m = lemmas.select(F.col("surface").alias("_s"), F.col("lemma").alias("_l"))
    out = words.join(m, F.col(surface) == F.col("_s"), "left")
    new = F.coalesce("_l", lemma)
    return out.withColumn("changed", ~new.eqNullSafe(F.col(lemma))).withColumn(lemma, new).drop("_s", "_l")


def backfill_transcripts(transcripts: DataFrame, lemmas: DataFrame, doc: str = "video") -> DataFrame:
    """Nested transcripts with lemmas from the map (surface, lemma), and ``changed``: how many words had another one. Running it again changes nothing.

    Words are exploded with their places and put back in order, so the map is joined like any table; a transcript without words stays as it is.
    """
    seg = transcripts.select(doc, F.posexplode("segments").alias("_si", "_s"))
    flat = seg.select(doc, "_si", F.posexplode("_s.words").alias("_wi", "_w")).select(doc, "_si", "_wi", "_w", F.col("_w.surface_form").alias("_f"))
    m = lemmas.select(F.col("surface").alias("_f"), F.col("lemma").alias("_l"))
    new = F.coalesce("_l", F.col("_w.lemma"))
    filled = flat.join(m, "_f", "left").select(doc, "_si", "_wi", F.col("_w").withField("lemma", new).alias("_w"), (~new.eqNullSafe(F.col("_w.lemma"))).cast("int").alias("_x"))
    words = filled.groupBy(doc, "_si").agg(F.array_sort(F.collect_list(F.struct("_wi", "_w"))).alias("_ws"), F.sum("_x").alias("_x"))
    segs = words.groupBy(doc).agg(F.map_from_entries(F.collect_list(F.struct("_si", F.transform("_ws", lambda x: x["_w"]).alias("v")))).alias("_m"), F.sum("_x").alias("_x"))
    out = transcripts.join(segs, doc, "left")
    put = F.transform("segments", lambda s, i: s.withField("words", F.coalesce(F.get(F.array(F.col("_m")[i]), F.lit(0)), s["words"])))
    return out.withColumn("segments", F.when(F.col("_m").isNull(), F.col("segments")).otherwise(put)).withColumn("changed", F.coalesce("_x", F.lit(0))).drop("_m", "_x")
