"""Classes, split maps, channel leaks and vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_digit

SPLITS = ("train", "val", "test")


def crosstab(df: DataFrame, row: Column, column: str, values: tuple[str, ...]) -> DataFrame:
    """(class, n per value): conditional counts in one aggregation, so absent values are 0."""
    return df.groupBy(row.alias("class")).agg(*(F.count_if(F.col(column) == v).alias(f"{v}_n") for v in values))


def vocabulary_table(df: DataFrame, label: str, split: str = "split", speaker: str = "speaker_id", channel: str = "channel") -> DataFrame:
    """Per class: rows per split, and distinct speakers and channels in train.

    Rows are counted per (class, speaker, channel) first; the distinct counts then see those few rows, not every row thrice.
    """
    per = df.groupBy(F.col(label).alias("class"), F.col(speaker).alias("_s"), F.col(channel).alias("_c")).agg(*(F.count_if(F.col(split) == s).alias(f"{s}_n") for s in SPLITS))
    train = F.col("train_n") > 0
    return per.groupBy("class").agg(
        *(F.sum(f"{s}_n").alias(f"{s}_n") for s in SPLITS), F.count_distinct(F.when(train, F.col("_s"))).alias("n_speakers"), F.count_distinct(F.when(train, F.col("_c"))).alias("n_channels")
    )


def choose_vocabulary(table: DataFrame, min_train: int = 300, min_speakers: int = 5, drop_digits: bool = True, stoplist: DataFrame | None = None) -> DataFrame:
    out = table.where((F.col("train_n") >= min_train) & (F.col("n_speakers") >= min_speakers))
    if drop_digits:
        out = out.where(~has_digit("class"))
    return out.join(stoplist.select(F.col("word").alias("class")), "class", "left_anti") if stoplist is not None else out


def vocabulary_removals(table: DataFrame, min_train: int, min_speakers: int, stoplist: DataFrame | None = None) -> DataFrame:
    """(step, removed): classes each filter removes, in order, of those the filters before it left."""
    t = table
    if stoplist is not None:
        t = t.join(stoplist.select(F.col("word").alias("class"), F.lit(True).alias("_stop")), "class", "left")
    else:
        t = t.withColumn("_stop", F.lit(None).cast("boolean"))
    step = F.when(F.col("train_n") < min_train, "min_train").when(F.col("n_speakers") < min_speakers, "min_speakers").when(has_digit("class"), "digit").when(F.col("_stop"), "stoplist").otherwise("kept")
    return t.groupBy(step.alias("step")).agg(F.count("*").alias("classes"))


def leaked(df: DataFrame, split: str = "split", channel: str = "channel") -> DataFrame:
    """Add ``leaked``: a train row on a channel that test has."""
    test = df.where((F.col(split) == "test") & F.col(channel).isNotNull()).select(F.col(channel).alias("_ch")).distinct()
    out = df.join(test, F.col(channel) == F.col("_ch"), "left")
    return out.withColumn("leaked", (F.coalesce(F.col(split), F.lit("")) == "train") & F.col("_ch").isNotNull()).drop("_ch")


def in_vocabulary(df: DataFrame, label: str, vocab: DataFrame, name: str) -> DataFrame:
    """Add a 0/1 membership flag."""
    v = vocab.select(F.col("class").alias("_v")).distinct()
    return df.join(v, F.col(label) == F.col("_v"), "left").withColumn(name, F.col("_v").isNotNull().cast("int")).drop("_v")


def dense(classes: DataFrame, values: list[str], counts: DataFrame, name: str = "split") -> DataFrame:
    """Every class with every value, counts filled with 0: the values are a short list, so each class is exploded into them."""
    grid = classes.select("class").withColumn(name, F.explode(F.array(*map(F.lit, values))))
    n = [c for c in counts.columns if c not in ("class", name)]
    return grid.join(counts, ["class", name], "left").fillna(0, n)


def top_share(df: DataFrame, label: Column, owner: str) -> DataFrame:
    """(class, n, top_share): the largest owner's share of a class."""
    per = df.groupBy(label.alias("class"), owner).agg(F.count("*").alias("n"))
    return per.groupBy("class").agg(F.sum("n").alias("n"), F.round(F.max("n") / F.sum("n"), 6).alias("top_share"))


def labelled(df: DataFrame, classes: dict[str, str], vocab: DataFrame) -> DataFrame:
    """Add ``in_vocab_<labeling>`` and ``label_<labeling>`` ('' outside the vocabulary) for each labeling and its class column."""
    for labeling, column in classes.items():
        df = in_vocabulary(df, column, vocab.where(F.col("labeling") == labeling), f"in_vocab_{labeling}")
        df = df.withColumn(f"label_{labeling}", F.when(F.col(f"in_vocab_{labeling}") == 1, F.col(column)).otherwise(""))
    return df
