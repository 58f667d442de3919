"""Incremental runs over growing manifests with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import commit_tables


def stream_manifest(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000, kind: str = "parquet") -> DataFrame:
    """New files of a folder as a stream; the query's checkpoint is the set of files already done. A single file is its folder with that name."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and not fs.getFileStatus(p).isDirectory():
        return reader.option("pathGlobFilter", p.getName()).load(p.getParent().toString())
    return reader.load(path)


def run_available(stream: DataFrame, make: Callable[[DataFrame], dict[str, DataFrame]], root: str, marker: str, checkpoint: str) -> None:
    """Process what is there and stop. Each batch writes several tables, the marker last, under its batch id.

    A crash between tables leaves rows without a marker, which readers skip; the batch is repeated
    under the same id and overwrites them.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist()
        try:
            commit_tables(make(cached), root, marker, batch_id)
        finally:
            cached.unpersist()

    stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def sessions(events: DataFrame, keys: list[str], at: str, gap: str = "10 minutes", watermark: str | None = None) -> DataFrame:
    """Session windows, in batch or, with a watermark, on a stream."""
    e = events.withWatermark(at, watermark) if watermark and events.isStreaming else events
    s = e.groupBy(*keys, F.session_window(at, gap).alias("s")).agg(F.count("*").alias("n"))
    return s.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def windowed_counts(events: DataFrame, at: str, width: str, keys: list[str], watermark: str | None = None) -> DataFrame:
    e = events.withWatermark(at, watermark) if watermark and events.isStreaming else events
    return e.groupBy(F.window(at, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")
