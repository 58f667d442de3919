"""Session helpers: a local session factory and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CUTS: dict[str, SparkSession] = {}
_OWN: dict[str, str] = {}


def local_session(cpus: int | str = "*", app: str = "clipwright", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a temporary one on a local master; on a cluster every executor would write to its own disk and
    what is read back would be partial, so there it is an error.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="clipwright-")
    return _OWN[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, swept when Python exits."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    _CUTS[path] = spark
    return path


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a table in the shared folder and return a frame that reads it back.

    Cheaper than ``checkpoint()``, which computes its last stage twice, and as durable: the files
    outlive any executor. Release one early with :func:`release`; the rest goes when Python exits.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def release(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`cut`; nothing may read it afterwards."""
    path = getattr(df, "_cut_path", None)
    if path:
        _delete(df.sparkSession, path)
        df._cut_path = None


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)
    _CUTS.pop(path, None)


def sweep(spark: SparkSession) -> None:
    """Delete every intermediate table of a session, once the results that read them are written; a long session calls it between jobs."""
    for path in [p for p, s in _CUTS.items() if s.sparkContext is spark.sparkContext]:
        _delete(spark, path)


@atexit.register
def _sweep() -> None:
    for path, spark in list(_CUTS.items()):
        try:
            _delete(spark, path)
        except Exception:  # that session is gone; others may not be
            continue


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a table scan to all cores where its files are too few to occupy half of them.

    Only small inputs are: a table of many files or row groups has more partitions than that and is
    read as it lies, without a shuffle. Call it on a scan, whose partitions are known without a job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 2 < cores else scan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
