"""Readers of manifests, transcripts, exports, journals, lists, logs and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import turkish_lower
from ..schemas import EXPORT, TRANSCRIPT, staged
from ..session import _hadoop_path
from . import records

# Fragments a download leaves, and the containers of a whole video in order of preference.
FRAGMENT = r"\.f[0-9]+\.[^.]+$|\.part$"
VIDEO_EXTENSIONS = ["mp4", "mkv", "webm", "mov"]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def read_csv(spark: SparkSession, path: str, fields: dict[str, str], missing_ok: bool = True, ordinal: str | None = "row_pos") -> DataFrame:
    """An all-text manifest with its declared columns; absent file gives an empty table, or an error if not ``missing_ok``.

    Empty fields stay '' and words such as NA or null stay words. The header decides where columns are.
    """
    if not _exists(spark, path):
        if not missing_ok:
            raise FileNotFoundError(path)
        empty = spark.createDataFrame([], staged(fields))
        return empty.withColumn(ordinal, F.lit(0).cast("bigint")) if ordinal else empty
    opts = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8", "nullValue": "", "emptyValue": "", "charToEscapeQuoteEscaping": '"'}  # unset, a NUL after a quote is lost
    have = spark.read.options(**opts).csv(path)
    names = {c.lstrip("﻿").strip(): c for c in have.columns}
    if lost := [f for f in fields if f not in names]:
        raise ValueError(f"missing columns: {lost}")
    out = have.select(*(F.coalesce(F.col(f"`{names[f]}`"), F.lit("")).alias(f) for f in fields))
    return out.withColumn(ordinal, F.monotonically_increasing_id()) if ordinal else out


def read_manifest(spark: SparkSession, path: str, fields: dict[str, str], key: str = "clip_id") -> tuple[DataFrame, DataFrame]:
    """A manifest that may be in the middle of being written: the good rows, and (n_bad,).

    Trailing NULs are cut, and so is a last row without its line end or closing quote (together one bad row); rows
    without a key, with a NUL in it, or with an empty fps are bad; short rows are filled with '', over-long rows and
    blank lines are skipped uncounted. Line breaks inside quotes belong to their field. A file whose header is not
    complete yet is an empty table with one bad row. The file is read in splits, see :mod:`clipwright.sources.records`.
    """
    lines = records.read_lines(spark, path)
    p, fs = _hadoop_path(spark, path)
    size, ended = fs.getFileStatus(p).getLen(), False
    if size:
        stream = fs.open(p)
        try:
            stream.seek(size - 1)
            ended = stream.read() == ord("\n")
        finally:
            stream.close()
    head = lines.where("block = 0").select(F.regexp_extract(F.col("value").cast("string"), r"^([^\r\u0000]*)\r?\z", 1)).first()
    starts, total, inside = records.survey(lines)
    total -= not ended and not inside  # the last line ends no row
    if total < 1 or not head or not head[0]:
        return spark.createDataFrame([], staged(fields)).withColumn("row_pos", F.lit(0).cast("bigint")), spark.createDataFrame([(int(size > 0),)], "n_bad bigint")
    header = [c.lstrip("﻿").strip('"') for c in head[0].split(",")]
    if lost := [f for f in fields if f not in header]:
        raise ValueError(f"missing columns: {lost}")
    rates = [f for f in fields if f == "fps"]
    rows = records.parse(lines, starts, total, header, list(dict.fromkeys([*fields, key])), lambda r: not r[key] or b"\0" in r[key] or not all(r[f] for f in rates))
    return rows.where("NOT bad").select(*fields, "row_pos"), rows.agg((F.count_if("bad") + F.lit(int(inside or not ended))).alias("n_bad"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRANSCRIPT).json(path, multiLine=True).withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines journal (old, new) with the line order."""
    return spark.read.schema("old string, new array<string>").json(path).withColumn("ordinal", F.monotonically_increasing_id())


def read_map(spark: SparkSession, path: str, value: str = "int") -> DataFrame:
    """A JSON object file as rows (id, value)."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("id", "value"))


def read_exports(spark: SparkSession, path: str) -> DataFrame:
    """Annotation exports (JSON arrays of tasks) with the file's stem and the task order; a file without annotations is refused.

    So is one that is not one array, such as JSON lines: the parser reads the first value of a file and leaves the rest unsaid.
    """
    content = F.regexp_replace("value", r"^\uFEFF?\s+|^\uFEFF", "")
    one = F.coalesce(F.json_array_length(F.concat(F.lit("["), content, F.lit("]"))) == 1, F.lit(False)) & F.startswith(content, F.lit("["))
    torn = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file")).where((content != "") & ~one).select("file").collect()
    if torn:
        raise ValueError(f"not one array of tasks: {[r[0] for r in torn]}")
    raw = spark.read.schema(EXPORT).json(path, multiLine=True).select("*", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1).alias("stem")).withColumn("ordinal", F.monotonically_increasing_id())
    refused = raw.groupBy("stem").agg(F.min_by("annotations", "ordinal").alias("a")).where("a IS NULL").select("stem").collect()
    if refused:
        raise ValueError(f"not an annotation export: {[r[0] for r in refused]}")
    return raw


def read_words_list(spark: SparkSession, path: str) -> DataFrame:
    """A stop list: cut at the first #, trimmed, lower case, empty lines dropped, distinct."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(turkish_lower(line).alias("word")).where("word <> ''").distinct()


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """A list of links: empty lines and lines that start with # dropped."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> '' AND NOT startswith(url, '#')")


def read_log(spark: SparkSession, path: str, prefix: str = "[phase2]") -> DataFrame:
    """Lines of a log with their prefix, in order."""
    return spark.read.text(path).withColumn("ordinal", F.monotonically_increasing_id()).where(F.startswith("value", F.lit(prefix)))


def log_progress(lines: DataFrame) -> DataFrame:
    """(done, total, failed): the last progress mark ``n/m`` and the count of failures."""
    n = F.regexp_extract("value", r"(\d+)/(\d+)", 1)
    m = F.regexp_extract("value", r"(\d+)/(\d+)", 2)
    marked = F.when(n != "", F.col("ordinal"))
    return lines.agg(F.max_by(n.try_cast("int"), marked).alias("done"), F.max_by(m.try_cast("int"), marked).alias("total"), F.count_if(F.col("value").contains("FAILED")).alias("failed"))


def read_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, modified, bytes) of files; their content is never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def preferred_files(listing: DataFrame, stem: str, extensions: list[str]) -> DataFrame:
    """One file per stem, download fragments left out: by extension in the given order, then the newest."""
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    place = F.array_position(F.array(*map(F.lit, extensions)), ext)
    return listing.withColumn("_p", place).where((F.col("_p") > 0) & ~F.col("path").rlike(FRAGMENT)).groupBy(stem).agg(F.min_by("path", F.struct("_p", -F.unix_micros("modified"), "path")).alias("path"))


def missing_files(referenced: DataFrame, listing: DataFrame, path: str) -> DataFrame:
    return referenced.select(path).where(F.col(path).isNotNull()).distinct().join(listing.select(F.col("path").alias(path)), path, "left_anti")


def class_distribution(spark: SparkSession, path: str, label: str) -> DataFrame:
    """A published class list; its header may start with a byte order mark."""
    rows = read_csv(spark, path, {label: "string", "rank": "int", "count": "bigint", "speakers": "int"}, missing_ok=False, ordinal=None)
    return rows.select(label, F.col("rank").cast("int"), F.col("count").cast("bigint"), F.col("speakers").cast("int"))


def ranked_classes(counts: DataFrame, label: str) -> DataFrame:
    """Add ``rank`` by count, ties by class, from a range partition."""
    from ..operators.hotkeys import ranked

    return ranked(counts.withColumn("_all", F.lit(0)), ["_all"], [F.desc("count"), F.col(label).asc()], "rank").drop("_all")


def read_tensors(spark: SparkSession, path: str, fields: tuple[str, ...] = ("frames",), glob: str = "*.npz") -> DataFrame:
    """(path, field, shape, dtype, data) of tensor files; unreadable ones give no rows."""
    import io

    def load(pdfs):
        import numpy as np
        import pandas as pd

        for pdf in pdfs:
            rows = []
            for p, content in zip(pdf["path"], pdf["content"]):
                try:
                    z = np.load(io.BytesIO(content))
                    rows += [(p, f, list(z[f].shape), str(z[f].dtype), z[f].tobytes()) for f in fields if f in z]
                except Exception:
                    continue
            yield pd.DataFrame(rows, columns=["path", "field", "shape", "dtype", "data"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(load, "path string, field string, shape array<int>, dtype string, data binary")
