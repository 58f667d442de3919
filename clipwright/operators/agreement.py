"""Annotation exports, pairwise agreement, verified items and corrected ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_exports(exports: DataFrame, stem: str = "stem") -> DataFrame:
    """One row per answer of nested exports (columns ``stem``, ``data``, ``annotations``, and ``ordinal`` for file order).

    Cancelled answers and answers without a verdict are skipped; annotators are scoped by file, and one without a name is an empty one.
    """
    a = exports.select(stem, "ordinal", "data", F.posexplode("annotations").alias("n", "a")).where(~F.coalesce("a.was_cancelled", F.lit(False)))
    of = lambda name: F.get(F.filter("a.result", lambda r: r["from_name"] == name), F.lit(0))
    who = F.coalesce(F.get_json_object("a.completed_by", "$.email"), F.get_json_object("a.completed_by", "$.id"), F.col("a.completed_by"), F.lit(""))
    rows = a.select(
        F.col("data.kind").alias("kind"), F.col("data.clip_id").alias("clip_id"), F.col("data.split").alias("split"), F.col("data.speaker_id").alias("speaker_id"),
        F.col("data.auto_start_sec").alias("auto_start_sec"), F.col("data.auto_end_sec").alias("auto_end_sec"), F.concat_ws(":", stem, who).alias("annotator"),
        F.get(of("verdict")["value"]["choices"], F.lit(0)).alias("verdict"), F.coalesce(F.regexp_replace(F.array_join(of("label_fix")["value"]["text"], " "), r"^\p{Zs}+|\p{Zs}+$", ""), F.lit("")).alias("label_fix"),
        of("occ")["value"]["start"].alias("occ_start"), of("occ")["value"]["end"].alias("occ_end"), "ordinal", "n",
    )
    return rows.where(F.coalesce("verdict", F.lit("")) != "")


def last_verdicts(answers: DataFrame, order: list[str]) -> DataFrame:
    """An annotator's last verdict per item."""
    return answers.groupBy("kind", "clip_id", "annotator").agg(F.max_by("verdict", F.struct(*order)).alias("verdict"))


def annotator_pairs(verdicts: DataFrame) -> DataFrame:
    """Both verdicts of every two annotators on an item they share. Pairs within an item are bounded by its few annotators."""
    a = verdicts.select("kind", "clip_id", F.col("annotator").alias("a"), F.col("verdict").alias("va"))
    b = verdicts.select("kind", "clip_id", F.col("annotator").alias("b"), F.col("verdict").alias("vb"))
    return a.join(b, ["kind", "clip_id"]).where("a < b")


def confusion(pairs: DataFrame, by: list[str]) -> DataFrame:
    return pairs.groupBy(*by, "va", "vb").agg(F.count("*").alias("n"))


def cohen_kappa(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Per group: items, raw agreement and Cohen's kappa; null with fewer than two items or only one label overall."""
    cells = confusion(pairs, by)
    total = cells.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("va") == F.col("vb"), F.col("n")).otherwise(0)).alias("same"))
    rows = cells.groupBy(*by, F.col("va").alias("v")).agg(F.sum("n").alias("r"))
    cols = cells.groupBy(*by, F.col("vb").alias("v")).agg(F.sum("n").alias("c"))
    both = rows.join(cols, [*by, "v"], "full").groupBy(*by).agg(F.sum(F.coalesce("r", F.lit(0)) * F.coalesce("c", F.lit(0))).alias("rc"), F.count("*").alias("labels"))
    po, pe = F.col("same") / F.col("n"), F.col("rc") / F.col("n") / F.col("n")
    kappa = F.when((F.col("n") >= 2) & (F.col("labels") > 1), (po - pe) / (1 - pe))
    return total.join(both, by).select(*by, "n", F.round(po, 6).alias("agreement"), F.round(kappa, 6).alias("kappa"))


def verified_items(verdicts: DataFrame, fixes: DataFrame | None = None) -> DataFrame:
    """Per item: annotators, distinct verdicts, and whether all say correct."""
    out = verdicts.groupBy("kind", "clip_id").agg(
        F.count("*").cast("int").alias("n_annotators"), F.array_join(F.array_sort(F.collect_set("verdict")), "|").alias("verdicts"), F.min((F.col("verdict") == "correct").cast("int")).alias("verified")
    )
    return out if fixes is None else out.join(fixes, ["kind", "clip_id"], "left").fillna("", ["label_fix"])


def corrected_truth(queries: DataFrame, corrections: DataFrame) -> DataFrame:
    """Queries with the checked times. The automatic times are text on both sides and matched as text."""
    return queries.join(corrections, ["clip_id", "auto_start_sec", "auto_end_sec"])
