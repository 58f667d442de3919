"""Problem 1: one verdict and one corrected label per clip from annotators who disagree.

Latent ability-difficulty estimation. Annotator a names the true class z of item j with chance
s = sigmoid(ability[a, z] * exp(ease[j])), else one of the other classes after the error habits
error[a, z, .]. Gradient expectation-maximisation learns all of it jointly: a pass over the items
computes label posteriors and each item's ease (inner Newton steps, local to the item), and sums
the gradient, curvature and error counts per annotator; the abilities then take one Newton step.
Only sums per annotator leave a partition, never answers.

Items with the same answers of the same annotators are one weighted row in every pass, so a pass
grows with the distinct answer patterns, not with the items. Passes go on until no ability moves by
``TOLERANCE``, with halved steps once they swing; a model that still moves after ``PASSES`` is an error,
never returned. The abilities (160 bytes an annotator) are broadcast while there are at most
``MAX_BROADCAST_ANNOTATORS`` of them; beyond that they are joined to the answers by annotator and a
salt, so that a heavy annotator fills no task, with the same result. An item has at most one counted
answer per annotator, which bounds an item's row.

Of the two fields of ``p1_found`` the verdict is the model's; the label fix is, as its definition
asks, the plain vote of those who gave one on items the model calls wrong_word.

Defined results
  cancelled answers, blank or null verdicts   -> not counted
  several answers of one annotator on a clip  -> the latest created_at, then the greatest annotation_id
  null or empty annotator                     -> one unknown annotator, named ''
  ``unsure`` and unknown verdicts             -> abstain; a clip with nothing else has no verdict
  null clip_id or kind                        -> not counted
  ties between classes                        -> the class listed first in ``VERDICTS``
  empty table                                 -> empty result
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_key, trimmed
from ..session import cut, release
from .plainform import term_of, to_plain

VERDICTS = ("correct", "wrong_word", "offscreen", "bad_crop")
MAX_BROADCAST_ANNOTATORS, DRIVER_ROWS = 20_000, 100_000
PASSES, TOLERANCE, INNER = 300, 0.01, 3
#: Passes after which steps are halved, and parts of a heavy annotator.
SWING, SALT = 30, 16
ABILITY_MEAN, ABILITY_VAR, EASE_VAR, ERROR_PRIOR = 1.5, 4.0, 0.1, 0.3
K = len(VERDICTS)


def counted_answers(annotations: DataFrame) -> DataFrame:
    """The answers that count: kind, clip_id, annotator, verdict, label_fix."""
    verdict = F.regexp_replace(F.lower(trimmed("verdict")), " ", "_")
    a = annotations.select(
        F.lower(trimmed("kind")).alias("kind"), "clip_id", F.coalesce(clean_key("annotator"), F.lit("")).alias("annotator"),
        verdict.alias("verdict"), "label_fix", "created_at", "annotation_id", F.coalesce("was_cancelled", F.lit(False)).alias("gone"),
    )
    a = a.where("NOT gone AND verdict <> '' AND clip_id IS NOT NULL AND kind <> ''")
    last = F.max_by(F.struct("verdict", "label_fix"), F.struct("created_at", "annotation_id", "verdict", "label_fix")).alias("r")
    return a.groupBy("kind", "clip_id", "annotator").agg(last).select("kind", "clip_id", "annotator", "r.verdict", "r.label_fix")


def estimate(lab: np.ndarray, item: np.ndarray, starts: np.ndarray, ability: np.ndarray, error: np.ndarray, prior: np.ndarray):
    """Posteriors per item, ease per item, and per answer the gradient, curvature and error responsibilities.

    lab, item: per answer; starts: each item's first answer; ability [n, K] and error [n, K, K] are those of the answer's annotator.
    """
    n, items = len(lab), len(starts)
    hit = np.zeros((n, K))
    hit[np.arange(n), lab] = 1.0
    habit = np.log(np.take_along_axis(error, lab[:, None, None], axis=2)[:, :, 0])
    ease = np.zeros(items)
    for step in range(INNER + 1):
        x = np.exp(ease)[item][:, None]
        s = np.clip(1.0 / (1.0 + np.exp(-ability * x)), 1e-4, 1 - 1e-4)
        like = np.where(hit > 0, np.log(s), np.log1p(-s) + habit)
        post = np.log(prior) + np.add.reduceat(like, starts)
        post = np.exp(post - post.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        r = post[item]
        if step == INNER:
            break
        ax = ability * x
        g = np.add.reduceat((r * (hit - s) * ax).sum(1), starts) - ease / EASE_VAR
        h = np.add.reduceat((r * s * (1 - s) * ax * ax).sum(1), starts) + 1 / EASE_VAR
        ease = np.clip(ease + g / h, -1.0, 1.0)
    grad, curve = r * (hit - s) * x, r * s * (1 - s) * x * x
    wrong = r * (1 - hit)
    return post, ease, grad, curve, wrong


def stepped(ability, grad, curve, errors, scale: float = 1.0):
    """One Newton step of the abilities, and the error habits from their counts. Arrays [A, K], [A, K], [A, K], [A, K, K]."""
    g = grad - (ability - ABILITY_MEAN) / ABILITY_VAR
    ability = np.clip(ability + scale * np.clip(g / (curve + 1 / ABILITY_VAR), -2, 2), -6, 8)
    e = errors + ERROR_PRIOR
    e[:, np.arange(K), np.arange(K)] = 1e-9
    return ability, e / e.sum(2, keepdims=True)


def _fresh(n: int):
    e = np.full((n, K, K), 1 / (K - 1))
    e[:, np.arange(K), np.arange(K)] = 1e-9
    return np.full((n, K), ABILITY_MEAN), e


def _flat(batch: pa.RecordBatch):
    lists = batch.column("answers").combine_chunks() if isinstance(batch.column("answers"), pa.ChunkedArray) else batch.column("answers")
    offsets = np.asarray(lists.offsets)
    starts = offsets[:-1] - offsets[0]
    rows = lists.flatten()
    item = np.repeat(np.arange(len(starts)), np.diff(offsets))
    return rows, item, starts


_SUMS = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("sums", T.ArrayType(T.DoubleType()))])


def _sums_pass(batches: Iterator[pa.RecordBatch], ability, error, prior) -> Iterator[pa.RecordBatch]:
    """Per annotator: gradient, curvature, error counts; under -1: posterior mass per class and the items. One row each per partition."""
    n = len(ability)
    total, mass = np.zeros((n, 2 * K + K * K)), np.zeros(2 * K + K * K)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, item, starts = _flat(batch)
        who, lab = np.asarray(rows.field("a")), np.asarray(rows.field("l")).astype(np.int64)
        weight = np.asarray(batch.column("w")).astype(float)
        post, _, grad, curve, wrong = estimate(lab, item, starts, ability[who], error[who], prior)
        each = weight[item][:, None]
        grad, curve, wrong = grad * each, curve * each, wrong * each
        for k in range(K):
            total[:, k] += np.bincount(who, grad[:, k], n)
            total[:, K + k] += np.bincount(who, curve[:, k], n)
            cell = np.bincount(who * K + lab, wrong[:, k], n * K).reshape(n, K)
            total[:, 2 * K + k * K : 2 * K + (k + 1) * K] += cell
        mass[:K] += (post * weight[:, None]).sum(0)
        mass[K] += weight.sum()
    touched = np.flatnonzero(np.abs(total).sum(1))
    ids = pa.array([-1, *touched.tolist()], pa.int32())
    yield pa.RecordBatch.from_arrays([ids, pa.array([mass.tolist(), *total[touched].tolist()], pa.list_(pa.float64()))], names=["a", "sums"])


_POSTERIOR = "kind string, clip_id string, verdict string, support double, ease double, n_answers int"


def _posterior_pass(batches, ability, error, prior, joined: bool = False):
    schema = pa.schema([("kind", pa.string()), ("clip_id", pa.string()), ("verdict", pa.string()), ("support", pa.float64()), ("ease", pa.float64()), ("n_answers", pa.int32())])
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, item, starts = _flat(batch)
        lab = np.asarray(rows.field("l")).astype(np.int64)
        a, e = _joined_params(rows) if joined else (ability[np.asarray(rows.field("a"))], error[np.asarray(rows.field("a"))])
        post, ease, *_ = estimate(lab, item, starts, a, e, prior)
        best = post.argmax(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("kind").cast(pa.string()), batch.column("clip_id").cast(pa.string()), pa.array([VERDICTS[b] for b in best], pa.string()),
             pa.array(post.max(1)), pa.array(ease), pa.array(np.bincount(item, minlength=len(starts)), pa.int32())], schema=schema)


def _joined_params(rows: pa.StructArray):
    n = len(rows)
    ability = np.asarray(rows.field("ability").flatten()).reshape(n, K)
    return ability, np.asarray(rows.field("error").flatten()).reshape(n, K, K)


def _joined_pass(batches, prior):
    """As ``_sums_pass`` with the parameters in the rows: one row of contributions per answer, summed by Spark."""
    schema = pa.schema([("annotator", pa.string()), ("sums", pa.list_(pa.float64()))])
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, item, starts = _flat(batch)
        lab = np.asarray(rows.field("l")).astype(np.int64)
        post, _, grad, curve, wrong = estimate(lab, item, starts, *_joined_params(rows), prior)
        cell = np.zeros((len(lab), K, K))
        cell[np.arange(len(lab)), :, lab] = wrong
        each = np.hstack([grad, curve, cell.reshape(len(lab), K * K)])
        mass = np.zeros((1, each.shape[1]))
        mass[0, :K], mass[0, K] = post.sum(0), len(post)
        names = pa.concat_arrays([rows.field("annotator").cast(pa.string()), pa.array([None], pa.string())])
        yield pa.RecordBatch.from_arrays([names, pa.array(np.vstack([each, mass]).tolist(), pa.list_(pa.float64()))], schema=schema)


def _summed(df: DataFrame, key: str) -> DataFrame:
    width = 2 * K + K * K
    return df.groupBy(key).agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width))).select(key, F.array(*(f"s{i}" for i in range(width))).alias("sums"))


def _unpack(sums: np.ndarray):
    return sums[:, :K], sums[:, K : 2 * K], sums[:, 2 * K :].reshape(-1, K, K).copy()


class Consensus:
    """The fitted model: ``items`` (posteriors) and ``annotators`` (name, ability and error per class)."""

    def __init__(self, items: DataFrame, annotators: DataFrame, prior: np.ndarray):
        self.items, self.annotators, self.prior = items, annotators, prior


def fit(answers: DataFrame, max_broadcast: int = MAX_BROADCAST_ANNOTATORS, passes: int = PASSES) -> Consensus:
    """Fit to counted answers (kind, clip_id, annotator, verdict)."""
    spark = answers.sparkSession
    code = F.coalesce(*(F.when(F.col("verdict") == v, F.lit(i)) for i, v in enumerate(VERDICTS)))
    votes = cut(answers.select("kind", "clip_id", "annotator", code.alias("l")).where("l IS NOT NULL"))
    names = sorted(r[0] for r in votes.select("annotator").distinct().limit(max_broadcast + 1).collect())
    if len(names) > max_broadcast:
        return _fit_joined(votes, passes)
    ids = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "annotator string, a int")
    # One row per item, once; every pass reads it.
    items = cut(votes.join(F.broadcast(ids), "annotator").groupBy("kind", "clip_id").agg(F.array_sort(F.collect_list(F.struct("a", "l"))).alias("answers")))
    patterns = cut(items.groupBy("answers").agg(F.count("*").alias("w")))
    few = patterns.rdd.getNumPartitions() * (len(names) + 1) <= DRIVER_ROWS
    ability, error = _fresh(len(names))
    prior = np.full(K, 1 / K)
    for n in range(passes if names else 0):
        args = (ability, error, prior)
        part = patterns.mapInArrow(lambda it, args=args: _sums_pass(it, *args), _SUMS)
        # At most DRIVER_ROWS rows of 24 sums come back: as they are where partitions x annotators is no more, else summed to one an annotator.
        got = (part if few else _summed(part, "a")).toArrow()
        who, each = got["a"].to_numpy(), np.stack(got["sums"].to_pylist())
        sums, mass = np.zeros((len(names), 2 * K + K * K)), each[who < 0].sum(0)[: K + 1]
        np.add.at(sums, who[who >= 0], each[who >= 0])
        new, error = stepped(ability, *_unpack(sums), _scale(n))
        prior = (mass[:K] + 1) / (mass[K] + K)
        moved, ability = np.abs(new - ability).max() / _scale(n), new
        if moved < TOLERANCE:
            break
    else:
        _unsettled(passes, bool(names))
    release(patterns)
    args = (ability, error, prior)
    out = items.mapInArrow(lambda it: _posterior_pass(it, *args), _POSTERIOR)
    params = [(n, ability[i].tolist(), error[i].ravel().tolist()) for i, n in enumerate(names)]
    return Consensus(out, spark.createDataFrame(params, "annotator string, ability array<double>, error array<double>"), prior)


def _scale(n: int) -> float:
    return 1.0 if n < SWING else 0.5


def _unsettled(passes: int, any_votes: bool) -> None:
    if any_votes:
        raise RuntimeError(f"abilities still moving after {passes} passes")


def _fit_joined(votes: DataFrame, passes: int) -> Consensus:
    """The way for annotators too many to broadcast: parameters live in a table and are joined to the votes."""
    fresh_a, fresh_e = _fresh(1)
    lit = lambda xs: F.array(*(F.lit(float(x)) for x in xs))
    # The salt goes by item, so a heavy annotator's answers meet its parameters in SALT places.
    votes = cut(votes.withColumn("salt", F.pmod(F.xxhash64("kind", "clip_id"), F.lit(SALT)).cast("int")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    params = cut(votes.select("annotator").distinct().select("annotator", lit(fresh_a[0]).alias("ability"), lit(fresh_e[0].ravel()).alias("error")))
    prior = np.full(K, 1 / K)

    def attached() -> DataFrame:
        return votes.join(params.select("*", salts), ["annotator", "salt"]).groupBy("kind", "clip_id").agg(F.array_sort(F.collect_list(F.struct("annotator", "l", "ability", "error"))).alias("answers"))

    def newton(pdfs, scale):
        for pdf in pdfs:
            if len(pdf):
                a, e = stepped(np.stack(pdf["ability"].to_list()), *_unpack(np.stack(pdf["sums"].to_list())), scale)
                moved = np.abs(a - np.stack(pdf["ability"].to_list())).max(1) / scale
                yield pdf.assign(ability=list(a), error=list(e.reshape(len(a), -1)), moved=moved)[["annotator", "ability", "error", "moved"]]

    for n in range(passes):
        p = prior
        sums = cut(_summed(attached().mapInArrow(lambda it, p=p: _joined_pass(it, p), "annotator string, sums array<double>"), "annotator"))
        mass = sums.where("annotator IS NULL").collect()
        if not mass:
            break
        prior = (np.array(mass[0]["sums"][:K]) + 1) / (mass[0]["sums"][K] + K)
        new = cut(params.join(sums, "annotator").mapInPandas(lambda it, n=n: newton(it, _scale(n)), "annotator string, ability array<double>, error array<double>, moved double"))
        params = new.drop("moved")
        if new.agg(F.max("moved")).first()[0] < TOLERANCE:
            break
    else:
        _unsettled(passes, True)
    p = prior
    return Consensus(attached().mapInArrow(lambda it: _posterior_pass(it, None, None, p, True), _POSTERIOR), params, prior)


def label_fixes(answers: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The corrected label most annotators gave: word clips of verdict wrong_word, two givers at least, no tie."""
    given = answers.where("kind = 'word' AND verdict = 'wrong_word' AND label_fix IS NOT NULL AND label_fix <> ''").select("clip_id", "annotator", "label_fix")
    terms = to_plain(given, "label_fix").select("clip_id", "annotator", term_of("label_fix").alias("value")).where("value <> ''")
    votes = terms.groupBy("clip_id", "value").agg(F.count_distinct("annotator").alias("n"))
    best = votes.groupBy("clip_id").agg(F.max(F.struct("n", "value")).alias("top"), F.collect_list("n").alias("ns"))
    sole = best.where("top.n >= 2 AND size(filter(ns, x -> x = top.n)) = 1").select("clip_id", F.col("top.value").alias("value"))
    wrong = verdicts.where("kind = 'word' AND verdict = 'wrong_word'").select("clip_id")
    return sole.join(wrong, "clip_id", "left_semi")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = cut(counted_answers(spark.read.parquet(f"{sf_dir}/annotations.parquet")))
    items = cut(fit(answers).items)
    verdicts = items.select("kind", "clip_id", F.lit("verdict").alias("field"), F.col("verdict").alias("value"))
    fixes = label_fixes(answers, items).select(F.lit("word").alias("kind"), "clip_id", F.lit("label_fix").alias("field"), "value")
    return verdicts.unionByName(fixes)


def p1_annotators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reliability per annotator: answers, expected accuracy, and agreement with the consensus beyond chance."""
    answers = cut(counted_answers(spark.read.parquet(f"{sf_dir}/annotations.parquet")))
    model = fit(answers)
    items = cut(model.items)
    own = answers.where(F.col("verdict").isin(*VERDICTS)).join(items.select("kind", "clip_id", F.col("verdict").alias("agreed")), ["kind", "clip_id"])
    cells = own.groupBy("annotator", "verdict", "agreed").agg(F.count("*").alias("n"))
    rows = cells.groupBy("annotator", "verdict").agg(F.sum("n").alias("r"))
    cols = cells.groupBy("annotator", F.col("agreed").alias("verdict")).agg(F.sum("n").alias("c"))
    chance = rows.join(cols, ["annotator", "verdict"], "full").groupBy("annotator").agg(F.sum(F.coalesce("r", F.lit(0)) * F.coalesce("c", F.lit(0))).alias("rc"))
    seen = cells.groupBy("annotator").agg(F.sum("n").alias("n_answers"), F.sum(F.when(F.col("verdict") == F.col("agreed"), F.col("n")).otherwise(0)).alias("hits"))
    po, pe = F.col("hits") / F.col("n_answers"), F.col("rc") / F.col("n_answers") / F.col("n_answers")
    skill = F.aggregate("ability", F.lit(0.0), lambda acc, x: acc + 1 / (1 + F.exp(-x))) / K
    out = seen.join(chance, "annotator").join(model.annotators, "annotator")
    return out.select("annotator", "n_answers", F.round(po, 6).alias("agreement"), F.round(F.when(pe < 1, (po - pe) / (1 - pe)), 6).alias("kappa"), F.round(skill, 6).alias("reliability"))


def p1_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Krippendorff's alpha (nominal) of the counted verdicts per kind, abstentions left out."""
    answers = counted_answers(spark.read.parquet(f"{sf_dir}/annotations.parquet")).where(F.col("verdict").isin(*VERDICTS))
    cells = answers.groupBy("kind", "clip_id", "verdict").agg(F.count("*").alias("n"))
    items = cells.groupBy("kind", "clip_id").agg(F.sum("n").alias("m"), F.sum(F.col("n") * (F.col("n") - 1)).alias("same")).where("m > 1")
    paired = cells.join(items.select("kind", "clip_id"), ["kind", "clip_id"], "left_semi")
    marg = paired.groupBy("kind", "verdict").agg(F.sum("n").alias("n")).groupBy("kind").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("nn"))
    obs = items.groupBy("kind").agg(F.count("*").alias("n_items"), F.sum(F.col("same") / (F.col("m") - 1)).alias("o"))
    po, pe = F.col("o") / F.col("n"), F.col("nn") / (F.col("n") * (F.col("n") - 1))
    return obs.join(marg, "kind").select("kind", "n_items", F.col("n").alias("n_answers"), F.round(po, 6).alias("agreement"), F.round(F.when(pe < 1, (po - pe) / (1 - pe)), 6).alias("alpha"))
