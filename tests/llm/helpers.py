"""Small versions of the driver tables, written to a folder, with dirt on request."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF

TABLES = ("word_clips", "sentence_clips", "lemma_classes_605", "annotations", "eval_passages", "documents")
#: Names the operators use inside; a table that brings them must not disturb.
CLASHING = ("plain", "strange", "rank", "_rank", "_r", "_at", "_n", "key", "id", "unit", "unit_id", "speaker", "term", "terms", "n", "cid", "side", "piece", "tokens", "container", "g", "restored", "garbled_spans", "mark", "item", "answers", "a", "l", "value", "field", "block", "raw")


def schema(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").schema


def write(spark, folder, name, dicts):
    s = schema(spark, name)
    rows = [tuple(d.get(f.name) for f in s) for d in dicts]
    spark.createDataFrame(rows, s).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def write_all(spark, folder, **tables):
    for t in TABLES:
        write(spark, folder, t, tables.get(t, []))
    return str(folder)


def at(n):
    return datetime.datetime(2026, 1, 1) + datetime.timedelta(seconds=n)


def with_extras(spark, folder, dirty=False):
    """The smallest driver tables with clashing extra columns; dirty adds a row of nulls and repeats some rows."""
    for t in TABLES:
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if dirty:
            nulls = df.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema))
            df = df.unionByName(nulls)
        have = {f.name for f in df.schema}
        df = df.select("*", *(F.lit("x").alias(c) for c in CLASHING if c not in have))
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


__all__ = ["T", "TABLES", "at", "schema", "with_extras", "write", "write_all"]
