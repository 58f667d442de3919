"""Problem 7: per-key results when a few keys hold most rows, and exact ranks inside such keys.

Rows are range partitioned on (key, secondary order) with quantiles that Spark samples, so a heavy
key is split over as many partitions as its rows need. Each sorted partition is folded to one
partial state per key it touches; only those states meet again, and neighbours are stitched where a
run of equal ids crosses a partition boundary. No task ever holds a whole key.

Defined results
  null, empty and unknown keys -> one group under null, split and stitched like any other
  repeated rows                -> all counted in ``rows``; an id counts once in ``clips``, by its last row in order
  null id                      -> counted in ``rows`` only
  null measures                -> left out of sums and means; a mean of nothing is null
  empty table                  -> empty result
Extra columns are ignored; a column called like a result column does no harm, as inputs are aliased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_key
from ..session import cut, table

_STATE = "key string, rows bigint, clips bigint, hours double, conf double, conf_n bigint, first_id string, last_id string, last_hours double, last_conf double, last_conf_n bigint, part bigint"


def _merge(a: dict, b: dict) -> dict:
    """Two neighbouring states of one key, ``a`` before ``b``; a run of one id across the seam counts by ``b``."""
    same = a["last_id"] is not None and a["last_id"] == b["first_id"]
    out = dict(b)
    for total, last in (("clips", None), ("hours", "last_hours"), ("conf", "last_conf"), ("conf_n", "last_conf_n")):
        out[total] = a[total] + b[total] - ((1 if last is None else a[last]) if same else 0)
    out["rows"] = a["rows"] + b["rows"]
    out["first_id"] = a["first_id"] if a["first_id"] is not None else b["first_id"]
    if b["last_id"] is None:
        out.update({k: a[k] for k in ("last_id", "last_hours", "last_conf", "last_conf_n")})
    return out


def _changes(x: pa.Array) -> np.ndarray:
    """Whether each row differs from the one before; nulls equal each other."""
    if len(x) < 2:
        return np.ones(len(x), bool)
    a, b = x[1:], x[:-1]
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))
    return np.concatenate([[True], differ])


def _states(batch: pa.RecordBatch) -> Iterator[dict]:
    key, ident = batch.column("key"), batch.column("id")
    hours = batch.column("hours").to_numpy(zero_copy_only=False)
    conf = batch.column("conf").to_numpy(zero_copy_only=False)
    new_key = _changes(key)
    # The last row of a run of one id speaks for it; rows without an id speak for nothing.
    ends = np.concatenate([(new_key | _changes(ident))[1:], [True]]) & ~pc.is_null(ident).to_numpy(zero_copy_only=False)
    h = np.where(ends, np.nan_to_num(hours), 0.0)
    has = ends & ~np.isnan(conf)
    c = np.where(has, np.nan_to_num(conf), 0.0)
    at = np.flatnonzero(new_key)
    sums = [np.add.reduceat(v, at) for v in (ends.astype(np.int64), h, c, has.astype(np.int64))]
    stops = np.append(at[1:], len(key))
    for i, (s, e) in enumerate(zip(at, stops)):
        inside = np.flatnonzero(ends[s:e])
        last = s + inside[-1] if len(inside) else None
        first = next((x for x in ident[s : s + 1].to_pylist()), None)
        if first is None and last is not None:  # nulls sort first
            first = ident[int(s + inside[0])].as_py()
        yield {
            "key": key[int(s)].as_py(), "rows": int(e - s), "clips": int(sums[0][i]), "hours": float(sums[1][i]), "conf": float(sums[2][i]), "conf_n": int(sums[3][i]),
            "first_id": first, "last_id": None if last is None else ident[int(last)].as_py(),
            "last_hours": 0.0 if last is None else float(h[last]), "last_conf": 0.0 if last is None else float(c[last]), "last_conf_n": 0 if last is None else int(has[last]),
        }


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "rows", "clips", "hours", "conf", "conf_n", "first_id", "last_id", "last_hours", "last_conf", "last_conf_n", "part"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))

    def made(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    part, held, done = None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py() if part is None else part
        for state in _states(batch):
            state["part"] = part
            if held is not None and held["key"] == state["key"]:
                held = _merge(held, state)
            else:
                done += [held] if held is not None else []
                held = state
        if len(done) > 50_000:
            yield made(done)
            done = []
    yield made([*done, *([held] if held is not None else [])])


def per_key(df: DataFrame, key: Column, ident: Column, order: Column, hours: Column, confidence: Column, partitions: int | None = None) -> DataFrame:
    """Per key: rows, clips (distinct ids), hours and mean confidence over the clips."""
    rows = df.select(key.alias("key"), ident.cast("string").alias("id"), order.alias("at"), hours.cast("double").alias("hours"), confidence.cast("double").alias("conf"))
    by = [F.col(c).asc_nulls_first() for c in ("key", "id", "at", "hours", "conf")]
    spread = rows.repartitionByRange(*((partitions, *by) if partitions else by)).sortWithinPartitions(*by)
    states = spread.select("key", "id", "hours", "conf", F.spark_partition_id().cast("bigint").alias("part")).mapInArrow(_fold, _STATE)
    # States of a key, at most one per partition, are stitched in range order.
    w = Window.partitionBy("key").orderBy("part")
    seam = states.withColumn("same", F.coalesce(F.lead("first_id").over(w) == F.col("last_id"), F.lit(False)))
    cutoff = lambda total, last: F.sum(F.col(total) - F.when(F.col("same"), last).otherwise(0))
    out = seam.groupBy("key").agg(
        F.sum("rows").alias("rows"), cutoff("clips", F.lit(1)).alias("clips"), cutoff("hours", F.col("last_hours")).alias("hours"),
        cutoff("conf", F.col("last_conf")).alias("c"), cutoff("conf_n", F.col("last_conf_n")).alias("n"),
    )
    return out.select("key", "rows", "clips", F.round("hours", 6).alias("hours"), F.round(F.when(F.col("n") > 0, F.col("c") / F.col("n")), 4).alias("mean_confidence"))


def ranked(df: DataFrame, keys: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Add the exact rank of each row within its key, in an order that is total, without one task per key.

    After a range partition and a local sort, a row's place in its partition is its place in the
    order; its rank is that place, less where its key's run starts, plus the key's rows in earlier
    partitions. The sorted rows are written once, as two scans must see the same places.
    """
    by = [*(F.col(k).asc_nulls_first() for k in keys), *order]
    placed = cut(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(part.alias("_p"), *keys).agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(F.col("_p").alias("_q"), *(F.col(k).alias(f"_k_{k}") for k in keys), "_start", "_skip")
    on = (part == F.col("_q")) & F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = placed.join(runs, on)
    return joined.withColumn(rank, F.col("_at") - F.col("_start") + F.col("_skip") + 1).drop("_at", "_q", "_start", "_skip", *(f"_k_{k}" for k in keys))


def _local_totals(batches: Iterator[pa.RecordBatch], keys: list[str], value: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds, per row of a sorted partition, the sum of the values before it in its key's run there."""
    held: tuple | None = None
    total = 0.0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new |= _changes(c)
        first = tuple(c[0].as_py() for c in cols)
        new[0] = first != held
        v = np.nan_to_num(batch.column(batch.schema.get_field_index(value)).cast(pa.float64()).to_numpy(zero_copy_only=False))
        out = np.zeros(batch.num_rows)
        at = np.flatnonzero(new)
        starts = np.concatenate([[0], at]) if not new[0] else at
        for s, e in zip(starts, np.append(starts[1:], batch.num_rows)):
            base = total if s == 0 and not new[0] else 0.0
            run = base + np.concatenate([[0.0], np.cumsum(v[s:e])])
            out[s:e] = run[:-1]
            total = float(run[-1])
        held = tuple(c[-1].as_py() for c in cols)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], schema=schema)


def running_totals(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before each in its key, in an order that is total, without one task per key.

    Sums inside a range partition are made where its rows lie; the totals of a key's earlier partitions are added. Null values count as 0.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    by = [*(F.col(k).asc_nulls_first() for k in keys), *order]
    kept = df.drop(name).columns
    placed = df.select(*kept).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_p", F.spark_partition_id())
    out = T.StructType([*placed.schema.fields, T.StructField("_run", T.DoubleType())])
    arrow = to_arrow_schema(out)
    local = cut(placed.mapInArrow(lambda it: _local_totals(it, keys, value, arrow), out))
    runs = local.groupBy("_p", *keys).agg(F.sum(F.coalesce(F.col(value).cast("double"), F.lit(0.0))).alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    skip = runs.select(F.col("_p").alias("_q"), *(F.col(k).alias(f"_k_{k}") for k in keys), F.coalesce(F.sum("_t").over(before), F.lit(0.0)).alias("_skip"))
    on = F.col("_p") == F.col("_q")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return local.join(skip, on).select(*kept, (F.col("_run") + F.col("_skip")).alias(name))


def speaker_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "word_clips")
    return per_key(w, clean_key("speaker_id"), F.col("clip_id"), F.col("appended_at"), F.col("n_frames") / F.col("fps") / 3600, F.col("confidence"))


def reporter_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "reporter_clips")
    return per_key(r, clean_key("reporter"), F.col("clip_file"), F.col("appended_at"), F.col("duration_sec") / 3600, F.lit(None))


def dominant(results: DataFrame, table_name: str, share: float = 0.025) -> DataFrame:
    kept = cut(results.select("key", "rows"))
    total = kept.agg(F.sum("rows").alias("total"))
    return kept.crossJoin(F.broadcast(total)).where((F.col("rows") > F.col("total") * share) & F.col("key").isNotNull()).select(F.lit(table_name).alias("table_name"), F.col("key").alias("key_value"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dominant(reporter_results(spark, sf_dir), "reporter_clips").unionAll(dominant(speaker_results(spark, sf_dir), "word_clips"))


def p7_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speaker_results(spark, sf_dir)


def p7_reporters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporter_results(spark, sf_dir).drop("mean_confidence")
