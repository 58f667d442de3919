"""Writers: snapshots behind a pointer, append logs, single-file exports, marker-last commits."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _replace(spark: SparkSession, source, target) -> None:
    """Rename over what is there in one step: a reader sees the old file or the new one, and a crash loses neither."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    whole = target.getFileSystem(conf).makeQualified(target)
    hadoop.FileContext.getFileContext(whole.toUri(), conf).rename(source.getFileSystem(conf).makeQualified(source), whole, how)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole: to a temporary name, then renamed."""
    jvm = spark.sparkContext._jvm
    p, fs = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    _replace(spark, tmp, p)


def read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def commit_snapshot(df: DataFrame, root: str) -> str:
    """Rewrite a table: a new snapshot folder, then the pointer. Readers see the old one or the new one, never a mix."""
    name = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    write_text(df.sparkSession, f"{root}/CURRENT", name)
    return name


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    name = read_text(spark, f"{root}/CURRENT")
    return spark.read.parquet(f"{root}/{name.strip()}") if name else None


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def record_completions(rows: DataFrame, key: str, log: str, at: str) -> None:
    """Completion is an appended event, not a flag rewritten in place, so no update is lost."""
    rows.select(key, F.lit(at).alias("completed_at")).write.mode("append").parquet(log)


def with_completions(queue: DataFrame, completions: DataFrame, key: str) -> DataFrame:
    done = completions.select(key).distinct().withColumn("_d", F.lit(True))
    return queue.join(done, key, "left").withColumn("completed", F.when(F.coalesce("_d", F.lit(False)) | (F.col("completed") == "1"), "1").otherwise("")).drop("_d")


_CSV = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxRecordsPerFile": "0"}


def export_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One CSV file for people: for final, small tables only; everything inside stays parquet. White space at the ends of a field is kept."""
    spark = df.sparkSession
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    out = df.orderBy(*order) if order else df
    out.coalesce(1).write.options(header="true", **_CSV).csv(tmp)
    t, fs = _fs(spark, tmp)
    part = next(f.getPath() for f in fs.listStatus(t) if f.getPath().getName().startswith("part-"))
    p, _ = _fs(spark, path)
    _replace(spark, part, p)
    fs.delete(t, True)


def stream_csv(df: DataFrame, path: str, tail: str = "") -> None:
    """One CSV file of any size as of :func:`export_csv`, with some text after it.

    All tasks write a part; the driver streams them into the file in their order, holding none, and deletes each once it is copied.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    tmp, parts = f"{path}.{uuid.uuid4().hex}.tmp", f"{path}.{uuid.uuid4().hex}.parts"
    df.write.options(header="false", **_CSV).csv(parts)
    t, fs = _fs(spark, tmp)
    folder, _ = _fs(spark, parts)
    files = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
    head = ",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"\r\n') else c for c in df.columns)
    out = fs.create(t, True)
    try:
        out.write(bytearray(f"{head}\n".encode("utf-8")))
        for part in sorted(files, key=lambda f: int(f.getName().split("-")[1])):
            given = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(given, out, 1 << 20, False)
            finally:
                given.close()
            fs.delete(part, False)
        out.write(bytearray(tail.encode("utf-8")))
    finally:
        out.close()
    fs.delete(folder, True)
    _replace(spark, t, _fs(spark, path)[0])


def commit_tables(tables: dict[str, DataFrame], root: str, marker: str, batch_id: int | str) -> None:
    """Write a batch's tables, the marker last. A batch rewrites its own folders, so a repeated one changes nothing."""
    for name in [t for t in tables if t != marker] + [marker]:
        tables[name].write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")


def read_committed(spark: SparkSession, root: str, name: str, marker: str, key: str) -> DataFrame:
    """Rows whose source has its marker."""
    rows = spark.read.parquet(f"{root}/{name}")
    return rows if name == marker else rows.join(spark.read.parquet(f"{root}/{marker}").select(key).distinct(), key, "left_semi")


def to_documents(words: DataFrame, doc: str = "video") -> DataFrame:
    """Word rows back to one nested document per recording."""
    w = F.struct(F.col("idx"), F.struct("surface_form", "lemma", "start_sec", "end_sec", "confidence", "manual_review").alias("w"))
    segs = words.groupBy(doc, "seg").agg(F.array_sort(F.collect_list(w)).alias("ws")).withColumn("words", F.transform("ws", lambda x: x["w"]))
    seg = F.struct("seg", F.struct(F.element_at("words", 1)["start_sec"].alias("start_sec"), F.element_at("words", -1)["end_sec"].alias("end_sec"), F.array_join(F.transform("words", lambda x: x["surface_form"]), " ").alias("text"), F.col("words")).alias("s"))
    return segs.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(seg)), lambda x: x["s"]).alias("segments"))


def write_params(spark: SparkSession, path: str, params: dict) -> None:
    write_text(spark, path, json.dumps(params, ensure_ascii=False, indent=1, sort_keys=True))


def split_map(spark: SparkSession, params: dict) -> DataFrame:
    """(speaker_id, split) of a parameter file's ``speakers``; a handful of names, given by a person."""
    rows = [(s, split) for split, names in params.get("speakers", {}).items() for s in names]
    return spark.createDataFrame(rows, "speaker_id string, split string")


class Report:
    """Metrics of a run as rows (stage, metric, value)."""

    def __init__(self):
        self.rows: list[tuple[str, str, str]] = []

    def add(self, stage: str, metric: str, value) -> None:
        self.rows.append((stage, metric, str(value)))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "stage string, metric string, value string")


def append_journal(rows: DataFrame, path: str) -> None:
    """Append (old, new) lines to a JSON-lines journal that :func:`clipwright.sources.manifests.read_journal` reads."""
    rows.select("old", F.col("new").cast("array<string>").alias("new")).write.mode("append").json(path)


def write_exports(tasks: DataFrame, root: str, by: str) -> None:
    """Tasks as annotation exports that :func:`clipwright.sources.manifests.read_exports` reads, a column ``by`` telling them apart.

    Each file is one JSON array of tasks of one export, in their order. A long export takes several files of at most
    65,536 tasks, so no task has to hold a whole one.
    """
    task = F.struct(F.monotonically_increasing_id().alias("id"), F.to_json(F.struct(*(c for c in tasks.columns if c != by))).alias("json"))
    listed = tasks.select(F.col(by).alias("by"), task.alias("task")).groupBy("by", F.shiftright("task.id", 16)).agg(F.transform(F.array_sort(F.collect_list("task")), lambda t: t["json"]).alias("tasks"))
    listed.select(F.concat(F.lit("["), F.array_join("tasks", ",\n"), F.lit("]"))).write.option("maxRecordsPerFile", 1).text(root)
