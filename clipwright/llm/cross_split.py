"""Problem 3: the same or nearly the same sentence in training and in evaluation.

Exact prefix-filter join. Sentences become sequences of terms; equal sequences are one class. Two
sequences within d edits keep at least max(n, m) - 1 - 2d of their two-term shingles in place, so
with shingles ordered rarest first, both hold one of those among the first few (the prefix). The
prefixes of evaluation classes are the index; training prefixes probe it, filtered by length and by
how far the shingle moved. What remains is verified by edit distance over terms. Nothing is
approximate, and no bucket is capped: a shingle in the prefix of many classes is joined in full.

Defined results
  null text, null clip_id, fewer than MIN_TERMS terms -> no pairs
  source clip without a known split                   -> no pairs
  broken or repeated rows of a clip                   -> its row of latest appended_at
  copies                                              -> one class; every pair of its clips is reported
  empty table                                         -> empty result
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_key, turkish_lower
from ..session import cut
from .plainform import latest_rows, to_plain

MIN_TERMS, TOLERANCE = 8, 5


def term_sequence(plain: Column) -> Column:
    strip = lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.filter(F.transform(F.split(turkish_lower(plain), r"\s+"), strip), lambda w: w != "")


def sentence_sides(sentences: DataFrame, words: DataFrame) -> DataFrame:
    """(clip_id, channel, side, split, terms) of sentence clips in a known split."""
    splits = words.select("source_clip", F.lower(F.trim("split")).alias("split")).where("split IN ('train', 'val', 'test') AND source_clip IS NOT NULL")
    splits = splits.groupBy("source_clip").agg(F.max("split").alias("split"))
    rows = sentences.select("clip_id", "appended_at", "text", "source_clip", clean_key("channel", "-", "bilinmiyor").alias("channel"))
    rows = to_plain(latest_rows(rows, ["text", "source_clip", "channel"]).where("text IS NOT NULL"), "text")
    rows = rows.select("clip_id", "source_clip", "channel", term_sequence(F.col("text")).alias("terms")).where(F.size("terms") >= MIN_TERMS)
    side = F.when(F.col("split") == "train", F.lit("train")).otherwise(F.lit("eval"))
    return rows.join(splits, "source_clip").select("clip_id", "channel", "split", side.alias("side"), "terms")


def edits_allowed(n: Column, m: Column) -> Column:
    return F.floor(F.greatest(n, m) / TOLERANCE).cast("int")


def prefix_length(n: Column) -> Column:
    """How many of the n - 1 shingles, rarest first, must be looked at: n - 1 less the fewest that a partner of any length m keeps, plus 1.

    With m from n to n * 5/4 the fewest is kept at the smallest m of a block of equal d, so the sequence of m is short.
    """
    kept = F.array_min(F.transform(F.sequence(n, F.floor(n * TOLERANCE / (TOLERANCE - 1)).cast("int")), lambda m: m - 1 - 2 * F.floor(m / TOLERANCE).cast("int")))
    return F.greatest(n - 1 - kept + 1, F.lit(1))


def class_prefixes(classes: DataFrame) -> DataFrame:
    """(cid, side flags, n, key, places): the rarest shingles of each class with all their places."""
    sh = F.transform(F.sequence(F.lit(0), F.size("terms") - 2), lambda i: F.struct(F.xxhash64(F.get("terms", i), F.get("terms", i + 1)).alias("key"), i.alias("at")))
    rows = cut(classes.select("cid", "has_train", "has_eval", F.size("terms").alias("n"), F.explode(sh).alias("s")).select("cid", "has_train", "has_eval", "n", "s.key", "s.at"))
    freq = rows.groupBy("key").agg(F.count("*").alias("f"))
    keyed = rows.join(freq, "key").groupBy("cid", "has_train", "has_eval", "n").agg(F.array_sort(F.collect_list(F.struct("f", "key", "at"))).alias("s"))
    cutoff = keyed.withColumn("k", F.slice("s", 1, prefix_length(F.col("n"))))
    # A shingle cut in the middle of its repetitions keeps all its places, or the position filter could miss one.
    keys = cutoff.select("cid", "has_train", "has_eval", "n", "s", F.explode(F.array_distinct(F.transform("k", lambda x: x["key"]))).alias("key"))
    places = F.transform(F.filter("s", lambda x: x["key"] == F.col("key")), lambda x: x["at"])
    return keys.select("cid", "has_train", "has_eval", "n", "key", places.alias("places"))


def _within(a: Column, b: Column) -> Column:
    """Whether two sequences are within the edits allowed: terms become characters by their place in the pair's union, and the native function counts, stopping early.

    Characters start at U+10000, above the surrogates, which leaves room for 1,048,576 distinct terms in a pair.
    """
    union = F.array_union(a, b)
    code = lambda t: F.lpad(F.hex(F.array_position(union, t) - 1 + 0x10000), 8, "0")
    enc = lambda xs: F.decode(F.unhex(F.array_join(F.transform(xs, code), "")), "UTF-32")
    return F.call_function("levenshtein", enc(a), enc(b), edits_allowed(F.size(a), F.size(b))) >= 0


def near_classes(classes: DataFrame) -> DataFrame:
    """(eval_cid, train_cid) of classes within the allowed edits, equal classes included."""
    pre = cut(class_prefixes(classes))
    ev = pre.where("has_eval").select(F.col("cid").alias("eval_cid"), F.col("n").alias("en"), "key", F.col("places").alias("ep"))
    tr = pre.where("has_train").select(F.col("cid").alias("train_cid"), F.col("n").alias("tn"), "key", F.col("places").alias("tp"))
    d = edits_allowed(F.col("en"), F.col("tn"))
    near = F.exists("ep", lambda p: F.exists("tp", lambda q: F.abs(p - q) <= d))
    cand = ev.join(tr, "key").where((F.col("eval_cid") != F.col("train_cid")) & (F.abs(F.col("en") - F.col("tn")) <= d) & near).select("eval_cid", "train_cid").distinct()
    terms = classes.select("cid", "terms")
    both = cand.join(terms.select(F.col("cid").alias("eval_cid"), F.col("terms").alias("a")), "eval_cid").join(terms.select(F.col("cid").alias("train_cid"), F.col("terms").alias("b")), "train_cid")
    close = both.where(_within(F.col("a"), F.col("b"))).select("eval_cid", "train_cid")
    same = classes.where("has_train AND has_eval").select(F.col("cid").alias("eval_cid"), F.col("cid").alias("train_cid"))
    return close.unionAll(same)


def overlaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The clips with their class, and the pairs of classes that overlap."""
    sides = sentence_sides(spark.read.parquet(f"{sf_dir}/sentence_clips.parquet"), spark.read.parquet(f"{sf_dir}/word_clips.parquet"))
    clips = cut(sides.withColumn("cid", F.md5(F.array_join("terms", " "))))
    flag = lambda s: F.max((F.col("side") == s).cast("int")).cast("boolean")
    classes = cut(clips.groupBy("cid").agg(F.first("terms").alias("terms"), flag("train").alias("has_train"), flag("eval").alias("has_eval")))
    return clips, cut(near_classes(classes))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips, pairs = overlaps(spark, sf_dir)
    ev = clips.where("side = 'eval'").select(F.col("cid").alias("eval_cid"), F.col("clip_id").alias("x"))
    tr = clips.where("side = 'train'").select(F.col("cid").alias("train_cid"), F.col("clip_id").alias("y"))
    both = pairs.join(ev, "eval_cid").join(tr, "train_cid")
    return both.select(F.least("x", "y").alias("clip_id_a"), F.greatest("x", "y").alias("clip_id_b"))


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pairs per evaluation split and channel, counted by classes without expanding copies."""
    clips, pairs = overlaps(spark, sf_dir)
    ev = clips.where("side = 'eval'").groupBy(F.col("cid").alias("eval_cid"), "split", "channel").agg(F.count("*").alias("e"))
    tr = clips.where("side = 'train'").groupBy(F.col("cid").alias("train_cid")).agg(F.count("*").alias("t"))
    n = pairs.join(ev, "eval_cid").join(tr, "train_cid")
    return n.groupBy("split", "channel").agg(F.sum(F.col("e") * F.col("t")).alias("pairs"), F.count_distinct("eval_cid").alias("eval_texts"))


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's own result, in which copies are not expanded: every clip with its class and the number of overlapping classes of the other side."""
    clips, pairs = overlaps(spark, sf_dir)
    side = lambda c: pairs.groupBy(F.col(f"{c}_cid").alias("cid")).agg(F.count("*").alias("links")).select("cid", F.lit(c).alias("side"), "links")
    links = side("eval").unionAll(side("train"))
    return clips.join(links, ["cid", "side"]).select("clip_id", F.col("cid").alias("class_id"), "side", "links")
