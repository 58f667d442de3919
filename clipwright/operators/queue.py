"""Work queues: selection, de-overlap, idempotent merge, resume and order.

File order is priority, so every queue carries an explicit ``row_pos``; nothing relies on the order
of a DataFrame's rows. Sides of a join that may grow with the data carry no broadcast hint; Spark
broadcasts them only where its own statistics prove them small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import trimmed
from ..functions.urls import video_id


def flag(c: Column | str) -> Column:
    """Whether a 0/1 text column says yes; null and blanks say no."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == "1"


def select_rows(queue: DataFrame, pipelines=None, reporters=None, exclude=None, channels=None, limit: int | None = None) -> DataFrame:
    """Rows to work on in file order. Reporter filters touch pipeline 2 only; completed rows count towards the limit."""
    q = queue
    two = F.trim(F.coalesce(F.col("pipeline").cast("string"), F.lit(""))) == "2"
    if pipelines:
        q = q.where(F.trim(F.col("pipeline").cast("string")).isin(*map(str, pipelines)))
    if reporters:
        q = q.where(~two | F.trim("reporter").isin(*reporters))
    if exclude:
        q = q.where(~two | ~F.coalesce(F.trim("reporter"), F.lit("")).isin(*exclude))
    if channels:
        q = q.where(F.trim("channel").isin(*channels))
    return q.orderBy("row_pos").limit(limit) if limit else q


def without_done(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def committed_only(rows: DataFrame, marker: DataFrame, key: str) -> DataFrame:
    """Rows whose source has its marker; others were cut off by a crash."""
    return rows.join(marker.select(key).distinct(), key, "left_semi")


def channel_of(rows: DataFrame, links: DataFrame, url: str = "source_url") -> DataFrame:
    """Add ``channel``: the first known channel of the row's video in file order, '' if there is none."""
    known = links.select(video_id("url").alias("_id"), "channel", "row_pos").where(trimmed("channel") != "").where("_id IS NOT NULL")
    first = known.groupBy("_id").agg(F.min_by("channel", "row_pos").alias("channel"))
    out = rows.drop("channel").withColumn("_vid", video_id(url))
    return out.join(first, F.col("_vid") == F.col("_id"), "left").withColumn("channel", F.coalesce("channel", F.lit(""))).drop("_vid", "_id")


def validate_segments(rows: DataFrame, start: str, end: str, duration: str | None = None) -> DataFrame:
    """Add ``reason``: why a row's bounds can't be used, null if they can."""
    from ..functions.timing import parse_time

    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    s, e = parse_time(start), parse_time(end)
    if duration is not None:  # a row without bounds is the whole video
        whole = blank(start) & blank(end) & F.col(duration).isNotNull()
        s, e = F.when(whole, F.lit(0.0)).otherwise(s), F.when(whole, F.ceil(F.col(duration)).cast("double")).otherwise(e)
    reason = F.when(blank(start) != blank(end), "one_bound_missing").when(~blank(start) & (s.isNull() | e.isNull()), "unparseable").when(~blank(start) & (e <= s), "end_not_after_start")
    return rows.withColumn("start_sec", s).withColumn("end_sec", e).withColumn("reason", reason)


def greedy_overlap(rows: DataFrame, key: Column, pos: str, start: str, end: str, least: float = 1.0) -> DataFrame:
    """Keep a row unless it overlaps an already kept row of its key by ``least`` seconds or more. Adds ``kept``.

    A row without bounds covers the whole video and blocks all after it. The fold is sequential
    inside a key by definition; its state is the kept intervals, held as an array per key and built
    in file order, so a key costs one row of (pos, start, end) triples, never its payload.
    """
    item = F.struct(F.col(pos).alias("pos"), F.col(start).cast("double").alias("s"), F.col(end).cast("double").alias("e"))
    lists = rows.groupBy(key.alias("_key")).agg(F.array_sort(F.collect_list(item)).alias("xs"))
    kind = rows.schema[pos].dataType.simpleString()
    zero = F.expr(f"cast(array() as array<struct<pos:{kind},s:double,e:double,kept:boolean>>)")

    def step(acc: Column, x: Column) -> Column:
        whole = x["s"].isNull() | x["e"].isNull()
        hit = F.exists(acc, lambda k: k["kept"] & (k["s"].isNull() | k["e"].isNull() | (~whole & (F.least(k["e"], x["e"]) - F.greatest(k["s"], x["s"]) >= least))))
        one = F.struct(x["pos"].alias("pos"), x["s"].alias("s"), x["e"].alias("e"), (~hit).alias("kept"))
        return F.concat(acc, F.array(one))

    folded = lists.select("_key", F.explode(F.aggregate("xs", zero, step)).alias("x")).select(F.col("x.pos").alias(pos), F.col("x.kept").alias("kept"))
    return rows.join(folded, pos)


def merge_idempotent(base: DataFrame, incoming: DataFrame, ident: str, pos: str = "row_pos") -> tuple[DataFrame, DataFrame]:
    """The base with the incoming rows whose id it lacks, first of each id; and the counts (added, duplicates, unparseable)."""
    known = incoming.where(F.col(ident).isNotNull())
    first = known.withColumn("_r", F.row_number().over(Window.partitionBy(ident).orderBy(pos))).where("_r = 1").drop("_r")
    added = first.join(base.select(ident).distinct(), ident, "left_anti")
    n = incoming.agg(F.count("*").alias("n"), F.count(ident).alias("known")).crossJoin(added.agg(F.count("*").alias("added")))
    counts = n.select("added", (F.col("known") - F.col("added")).alias("duplicates"), (F.col("n") - F.col("known")).alias("unparseable"))
    return base.unionByName(added.select(*base.columns)), counts


def zero_clip_rows(queue: DataFrame, clips: DataFrame, queue_id: Column, clip_id: Column) -> DataFrame:
    """Completed rows no clip came of; a row without an id is left alone."""
    q = queue.where(flag("completed")).withColumn("_id", queue_id).where("_id IS NOT NULL")
    return q.join(clips.select(clip_id.alias("_id")).distinct(), "_id", "left_anti").drop("_id")


def stable_partition(queue: DataFrame, bucket: Column, pos: str = "row_pos") -> DataFrame:
    """New positions: by bucket, file order kept inside each. Offsets of the buckets are sums over bucket counts, ranks stay inside a bucket's ranges."""
    from .hotkeys import ranked

    q = queue.withColumn("bucket", bucket)
    counts = q.groupBy("bucket").agg(F.count("*").alias("_n"))
    offsets = counts.select(F.col("bucket").alias("_b"), F.coalesce(F.sum("_n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    placed = ranked(q, ["bucket"], [F.col(pos).asc()], "_r")
    return placed.join(F.broadcast(offsets), F.col("bucket") == F.col("_b")).withColumn("new_pos", F.col("_off") + F.col("_r")).drop("_b", "_off", "_r")


def height_class(rows: DataFrame, cache: DataFrame, ident: str, least: int = 720) -> DataFrame:
    """Add ``height_class``: unknown without a cached height, low below ``least``, else ok."""
    c = cache.select(F.col("id").alias("_id"), "height")
    return rows.join(c, rows[ident] == F.col("_id"), "left").drop("_id").withColumn("height_class", F.when(F.col("height").isNull(), "unknown").when(F.col("height") < least, "low").otherwise("ok"))


def replay_journal(rows: DataFrame, journal: DataFrame, key: str) -> DataFrame:
    """Replace a row by the 0..n rows a journal gives for it (``old`` -> ``new`` array, the later line wins)."""
    last = journal.groupBy("old").agg(F.max_by("new", "ordinal").alias("_new"))
    out = rows.join(last, rows[key] == last["old"], "left")
    return out.withColumn(key, F.explode(F.coalesce("_new", F.array(key)))).drop("old", "_new")


def budget_stop(rows: DataFrame, keys: list[str], pos: str, hours: str, most: float) -> DataFrame:
    """Rows taken while the hours of those before stay under the budget."""
    from .hotkeys import running_totals

    return running_totals(rows, keys, [F.col(pos).asc()], hours, "hours_before").where(F.col("hours_before") < most)


def deletion_plan(files: DataFrame, referenced: DataFrame, path: str = "path") -> DataFrame:
    """Files nothing refers to. A plan only: the engine never deletes."""
    return files.join(referenced.select(path).where(F.col(path).isNotNull()).distinct(), path, "left_anti")


def apply_plan(files: DataFrame, plan: DataFrame, path: str = "path", apply: bool = False, most_share: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """What is left of ``files``, and (planned, share, applied): a plan is applied only when told to, and only up to a share of all files."""
    gone = plan.select(path).distinct()
    n = files.agg(F.count("*").alias("_n")).crossJoin(files.join(gone, path, "left_semi").agg(F.count("*").alias("planned")))
    share = F.when(F.col("_n") > 0, F.col("planned") / F.col("_n")).otherwise(0.0)
    report = n.select("planned", F.round(share, 6).alias("share"), (F.lit(apply) & (share <= most_share)).alias("applied"))
    marked = files.join(gone.withColumn("_gone", F.lit(True)), path, "left").crossJoin(F.broadcast(report.select("applied")))
    return marked.where(F.col("_gone").isNull() | ~F.col("applied")).drop("_gone", "applied"), report


def select_pending(queue: DataFrame, done: DataFrame, keys: list[str], limit: int | None = None, **filters) -> DataFrame:
    """Selected rows that are not done, the limit last."""
    left = without_done(select_rows(queue, **filters), done, keys)
    return left.orderBy("row_pos").limit(limit) if limit else left


def subset(queue: DataFrame, columns: list[str], limit: int, pos: str = "row_pos") -> DataFrame:
    """A trial queue: the first rows in file order, none of them completed."""
    fresh = queue.withColumn("completed", F.lit("")) if "completed" in columns else queue
    return fresh.orderBy(pos).limit(limit).select(*columns)


def media_jobs(items: DataFrame, media: str, existing: DataFrame, path: str = "path") -> DataFrame:
    """One job per media file that does not exist yet: its first item in order of clip_id."""
    jobs = items.where(F.col(media).isNotNull()).groupBy(media).agg(F.min("clip_id").alias("clip_id"))
    return jobs.join(existing.select(F.col(path).alias(media)).distinct(), media, "left_anti")


def newest_per_source(listing: DataFrame, source: Column, modified: str = "modified") -> DataFrame:
    """(source, newest) of a file listing."""
    return listing.groupBy(source.alias("source")).agg(F.max(modified).alias("newest"))


def overlap_report(rows: DataFrame, key: Column, pos: str, start: str, end: str, least: float = 1.0) -> DataFrame:
    """(url, start, end, n): the intervals that overlap a kept one, with how often each occurs."""
    folded = greedy_overlap(rows, key, pos, start, end, least).where("NOT kept")
    return folded.groupBy(key.alias("url"), F.col(start).alias("start"), F.col(end).alias("end")).agg(F.count("*").alias("n"))
