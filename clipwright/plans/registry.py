"""Registered queries of the core operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, ids, text, timing, urls
from ..operators import agreement, graph, hotkeys, items, lemma, quality, queue, release, sampling, seq, splitsearch, spotting, stats, sync, vocab
from ..schemas import SPAN
from ..session import cut, scratch, table
from ..sources import manifests, sinks
from ..streaming import incremental
from . import extra
from .inputs import _K, _O, MIN_SPEAKERS, MIN_TRAIN, SEED, _clips, _events, _frames, _queries, _reporter_rows, _sentences, _verdicts, _vocab, _words

# --- classes, vocabulary, quality -------------------------------------------------------------


def token_classes(spark: SparkSession, d: str) -> DataFrame:
    w = _words(spark, d)
    flags = {"labelled": text.has_label("surface_form"), "suffixes": text.is_suffix("surface_form"), "latin": text.is_latin("surface_form"), "digits": text.has_digit("surface_form")}
    return w.groupBy(F.col("surface").alias("class")).agg(F.count("*").alias("n"), *(F.count_if(c).alias(n) for n, c in flags.items()), F.max(text.syllables("surface")).alias("syllables"))


def vocab_surface(spark: SparkSession, d: str) -> DataFrame:
    w = _words(spark, d).where(text.has_label("surface_form"))
    return vocab.choose_vocabulary(vocab.vocabulary_table(w, "surface"), MIN_TRAIN, MIN_SPEAKERS)


def vocab_lemma(spark: SparkSession, d: str) -> DataFrame:
    w = _words(spark, d).where(text.has_label("surface_form"))
    return vocab.choose_vocabulary(vocab.vocabulary_table(w, "lemma_cls"), MIN_TRAIN, MIN_SPEAKERS)


def vocab_removals(spark: SparkSession, d: str) -> DataFrame:
    stop = spark.createDataFrame([("ve",), ("bir",), ("bu",)], "word string")
    w = _words(spark, d).where(text.has_label("surface_form"))
    return vocab.vocabulary_removals(vocab.vocabulary_table(w, "surface"), MIN_TRAIN, MIN_SPEAKERS, stop)


def class_split_dense(spark: SparkSession, d: str) -> DataFrame:
    classes = _vocab(spark, d).select("class").distinct()
    counts = _words(spark, d).groupBy(F.col("lemma_cls").alias("class"), "split").agg(F.count("*").alias("n"))
    return vocab.dense(classes, list(vocab.SPLITS), counts)


def in_vocab_flags(spark: SparkSession, d: str) -> DataFrame:
    out = vocab.in_vocabulary(_words(spark, d), "lemma_cls", _vocab(spark, d).select("class"), "in_vocab_lemma")
    return out.groupBy("split", "in_vocab_lemma").agg(F.count("*").alias("n"))


def top_share(spark: SparkSession, d: str) -> DataFrame:
    return vocab.top_share(_words(spark, d).where("speaker_id IS NOT NULL"), F.col("lemma_cls"), "speaker_id")


def class_ranks(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "lemma_classes_605").groupBy(text.lemma_class("lemma").alias("lemma")).agg(F.max("count").alias("count"))
    return manifests.ranked_classes(c, "lemma")


def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.standalone_counts(table(spark, d, "word_clips"), quality.word_rules())


def quality_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d).groupBy("split", quality.first_reason(quality.word_rules()).alias("reason")).agg(F.count("*").alias("n"))


def small_faces(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d).groupBy("split").agg(F.round(quality.share_below("face_height_px", 150), 6).alias("below_150"), F.round(quality.share_below("face_height_px", 220), 6).alias("below_220"))


def empty_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.empty_profile(table(spark, d, "word_clips"))


def item_checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.item_checks(table(spark, d, "word_clips"))


def channel_leak(spark: SparkSession, d: str) -> DataFrame:
    return vocab.leaked(_words(spark, d)).groupBy("channel").agg(F.count("*").alias("n"), F.count_if("leaked").alias("leaked"))


def lemma_fallbacks(spark: SparkSession, d: str) -> DataFrame:
    return lemma.lemma_map(table(spark, d, "word_clips"), "surface_form")


def lemma_backfill(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "word_clips")
    return lemma.backfill(w, lemma.lemma_map(w, "surface_form")).groupBy("changed").agg(F.count("*").alias("n"))


def lemma_choice(spark: SparkSession, d: str) -> DataFrame:
    """The lemma of a surface by vote over the corpus: each row is one candidate analysis."""
    w = table(spark, d, "word_clips").where("surface_form IS NOT NULL AND lemma IS NOT NULL")
    n = F.length("lemma")
    intact = F.startswith("surface_form", F.substring("lemma", 1, 2)).cast("int")
    c = w.select(F.col("surface_form").alias("surface"), "lemma", (n % 2).alias("penalty"), (n % 3).alias("morphemes"), F.col("lemma").rlike("[ae]").cast("int").alias("open_class"), intact.alias("intact"), F.ascii("lemma").alias("ord"))
    return lemma.choose_lemma(c)


# --- sampling -----------------------------------------------------------------------------------


def train_cap(spark: SparkSession, d: str) -> DataFrame:
    c = sampling.train_cap(_clips(spark, d), "speaker_id", "lemma_cls", "split", "clip_id", 0.05, SEED)
    return c.where("capped").select("clip_id", "speaker_id", "lemma_cls")


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified(_clips(spark, d).select("clip_id", "split", "speaker_id"), ["split", "speaker_id"], "clip_id", 0.05, SEED)


def annotator_assignment(spark: SparkSession, d: str) -> DataFrame:
    return sampling.assign_annotators(_clips(spark, d).select("clip_id"), "clip_id", 0.1, SEED)


def per_class_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.up_to_k(_clips(spark, d).select("clip_id", "lemma_cls"), ["lemma_cls"], "clip_id", 20, SEED)


def global_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.head_of_hash(_clips(spark, d).select("clip_id"), "clip_id", 500, SEED)


def round_robin(spark: SparkSession, d: str) -> DataFrame:
    return sampling.round_robin(_clips(spark, d).where("speaker_id IS NOT NULL").select("clip_id", "speaker_id"), "speaker_id", "clip_id", 200, SEED)


def rank_slice(spark: SparkSession, d: str) -> DataFrame:
    return sampling.rank_slice(_words(spark, d).groupBy("lemma_cls").agg(F.count("*").alias("n")).where("lemma_cls IS NOT NULL"), "n", "lemma_cls", 40, 60)


def rarest_classes(spark: SparkSession, d: str) -> DataFrame:
    return sampling.rarest(_words(spark, d).groupBy("lemma_cls").agg(F.count("*").alias("n")).where("lemma_cls IS NOT NULL"), "n", "lemma_cls", 5)


def interleaved(spark: SparkSession, d: str) -> DataFrame:
    return sampling.interleave(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", "o_orderkey").select("o_orderkey", F.round("due", 2).alias("due"))


# --- spotting -----------------------------------------------------------------------------------


def spotting_queries(spark: SparkSession, d: str) -> DataFrame:
    return _queries(spark, d).drop("pos", "clamped")


def _held(spark: SparkSession, d: str) -> DataFrame:
    return _sentences(spark, d).where("split IN ('val', 'test')")


def spotting_negatives(spark: SparkSession, d: str) -> DataFrame:
    """For each class with enough sentences in test, sentences of val and of test without it."""
    held = cut(_held(spark, d))
    pool = held.select("split", "clip_id")
    q = cut(spotting.queries(spotting.spans(held), _vocab(spark, d)))
    classes = spotting.class_table(_vocab(spark, d), q, pool).where("evaluable = 1")
    wanted = classes.select("labeling", "class", F.explode(F.array(F.lit("val"), F.lit("test"))).alias("split"))
    return sampling.negatives(spotting.positives(q), pool, ["labeling", "class", "split"], "clip_id", 10, SEED, wanted)


def spotting_classes(spark: SparkSession, d: str) -> DataFrame:
    held = cut(_held(spark, d))
    q = spotting.queries(spotting.spans(held), _vocab(spark, d))
    return spotting.class_table(_vocab(spark, d), q, held.select("split", "clip_id"))


def spotting_clamped(spark: SparkSession, d: str) -> DataFrame:
    return spotting.clamped_spans(_queries(spark, d))


def occurrence_labels(spark: SparkSession, d: str) -> DataFrame:
    return spotting.occurrence_labels(_queries(spark, d))


def annotation_tasks(spark: SparkSession, d: str) -> DataFrame:
    return spotting.tasks(_clips(spark, d).where("split = 'test'"), ["clip_id", "split", "surface"])


def broken_spans(spark: SparkSession, d: str) -> DataFrame:
    return spotting.broken_spans(table(spark, d, "sentence_clips"))


# --- sequences ----------------------------------------------------------------------------------


def track_islands(spark: SparkSession, d: str) -> DataFrame:
    """Runs of events that are no error and move less than 5 from one to the next."""
    e = _events(spark, d).withColumn("solo", F.when(F.col("event_type") != "error", F.col("value")))
    prev = seq.before("solo", _K, _O)
    r = seq.islands(e, _K, _O, F.col("solo").isNull() | prev.isNull() | (F.abs(F.col("solo") - prev) >= 5), "track")
    return r.where("solo IS NOT NULL").groupBy("user_id", "track").agg(F.count("*").alias("n"), F.min("ts").alias("start"), F.max("ts").alias("end"), F.round(F.percentile("solo", F.lit(0.5)), 6).alias("median"))


def forward_filled(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    click = F.when(F.col("event_type") == "click", F.col("value"))
    return e.select("event_id", seq.forward_fill(click, _K, _O, -1.0).alias("forward"), seq.backward_fill(click, _K, _O).alias("backward"))


def centred_stats(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return _events(spark, d).select("event_id", F.round(seq.centred_mean(v, _K, _O, 2), 6).alias("mean5"), F.round(seq.centred_median(v, _K, _O, 6), 6).alias("median13"))


def median_filtered(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select("event_id", seq.median_filter(F.col("value"), _K, _O, 9).alias("filtered"))


def short_holes_filled(spark: SparkSession, d: str) -> DataFrame:
    return seq.fill_short_runs(_frames(spark, d), _K, ["k"], "status", 1, 0, 2).groupBy("user_id", "status").agg(F.count("*").alias("n"))


def spread_counts(spark: SparkSession, d: str) -> DataFrame:
    f = _frames(spark, d).withColumn("heads", F.when(F.col("k") % 5 == 0, F.when(F.col("value") > 20, 2).otherwise(1)))
    return seq.spread_counts(f, _K, ["k"], "status", "heads", 0, 9).groupBy("user_id", "status").agg(F.count("*").alias("n"))


def jumps(spark: SparkSession, d: str) -> DataFrame:
    f = _frames(spark, d).withColumn("y", F.col("value") / 2).withColumn("half", F.col("value") % 7 + 3)
    return seq.jump_flags(f, _K, ["k"], "value", "y", "half", F.col("status") == 0).select("event_id", "jump")


def smoothed(spark: SparkSession, d: str) -> DataFrame:
    f = seq.smoothed(_frames(spark, d), _K, ["k"], "value", F.col("status") == 0)
    return f.select("event_id", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


def padded_windows(spark: SparkSession, d: str) -> DataFrame:
    f = cut(_frames(spark, d))
    spans = f.where("status = 0").select("user_id", F.col("k").alias("f0"), (F.col("k") + 1).alias("f1"))
    return seq.padded_windows(f, spans, _K, "k", F.col("status") == 0, 15).select("user_id", "f0", "a", "b", "full_pad")


def pauses(spark: SparkSession, d: str) -> DataFrame:
    s = spotting.spans(_sentences(spark, d))
    return s.select("clip_id", "pos", F.round(seq.after("start_sec", ["clip_id"], ["pos"]) - F.col("end_sec"), 6).alias("pause"))


def last_session(spark: SparkSession, d: str) -> DataFrame:
    return seq.last_session(_events(spark, d).select("user_id", "event_id", "ts"), _K, "ts", 86400.0, 400).groupBy("user_id").agg(F.count("*").alias("n"), F.min("ts").alias("since"))


def recent_rates(spark: SparkSession, d: str) -> DataFrame:
    return seq.recent_rate(_events(spark, d), ["user_id"], "ts", 5).select("user_id", F.round("overall", 4).alias("overall"), F.round("recent", 4).alias("recent"))


def idle_users(spark: SparkSession, d: str) -> DataFrame:
    return seq.idle(_events(spark, d), ["user_id"], "ts", F.lit("2024-01-30 12:00:00"), 86400.0).select("user_id", "idle")


def change_points(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    changed = ~seq.before("event_type", _K, _O).eqNullSafe(F.col("event_type"))
    return e.select("user_id", "event_id", changed.alias("changed")).groupBy("user_id").agg(F.count_if("changed").alias("changes"), F.count("*").alias("n"))


def chunk_tiles(spark: SparkSession, d: str) -> DataFrame:
    c = F.floor(F.col("word_start_sec") / 5).cast("bigint")
    return _words(spark, d).groupBy("source_clip", c.alias("chunk")).agg(F.count("*").alias("n"))


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return incremental.sessions(_events(spark, d).withColumn("ts", F.col("ts").cast("timestamp")), ["user_id"], "ts", "6 hours").select("user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "n")


def hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    return incremental.windowed_counts(_events(spark, d).withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", ["event_type"]).select(F.unix_micros("window_start").alias("start_us"), "event_type", "n")


def streamed_words(spark: SparkSession, d: str) -> DataFrame:
    """word_clips read as a stream and committed with its marker last, then counted back per split."""
    root = scratch(spark, "stream")
    path = f"{d}/word_clips.parquet"
    schema = spark.read.parquet(path).select("clip_id", "source_clip", "split").schema
    stream = incremental.stream_manifest(spark, path, schema)

    def make(batch: DataFrame) -> dict[str, DataFrame]:
        return {"words": batch, "marker": batch.select("source_clip").distinct()}

    incremental.run_available(stream, make, root, "marker", f"{root}/_checkpoint")
    back = sinks.read_committed(spark, root, "words", "marker", "source_clip")
    return back.groupBy("split").agg(F.count("*").alias("n"))


# --- queue --------------------------------------------------------------------------------------


def queue_selection(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "speaker_table").select(F.col("speaker_id").alias("reporter"), F.col("split").alias("channel"), F.lit("2").alias("pipeline"), F.xxhash64("speaker_id").alias("_h"), F.lit("").alias("completed"), text.clean_key("speaker_id").alias("row_pos"))
    return queue.select_rows(s, pipelines=[2], exclude=["spk_0000001"], limit=50).select("reporter", "row_pos")


def greedy_overlap(spark: SparkSession, d: str) -> DataFrame:
    return queue.greedy_overlap(_reporter_rows(spark, d), urls.normalize_url("source_url"), "clip_file", "start_sec", "end_sec").select("clip_file", "kept")


def merged_speakers(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "speaker_table").select(text.clean_key("speaker_id").alias("speaker_id")).where("speaker_id IS NOT NULL").distinct()
    inc = _words(spark, d).select("speaker_id", F.col("clip_id").alias("row_pos"))
    return queue.merge_idempotent(base, inc, "speaker_id")[0]


def merge_counts(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "speaker_table").select(text.clean_key("speaker_id").alias("speaker_id")).distinct()
    inc = _words(spark, d).select("speaker_id", F.col("clip_id").alias("row_pos"))
    return queue.merge_idempotent(base, inc, "speaker_id")[1]


def zero_clip_rows(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "speaker_table").withColumn("completed", F.lit("1"))
    return queue.zero_clip_rows(q, table(spark, d, "reporter_clips"), text.clean_key("speaker_id"), text.clean_key("reporter")).select("speaker_id")


def stable_order(spark: SparkSession, d: str) -> DataFrame:
    b = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return queue.stable_partition(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), b, "o_orderkey").select("o_orderkey", "bucket", "new_pos")


def budget_stop(spark: SparkSession, d: str) -> DataFrame:
    return queue.budget_stop(table(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_totalprice", 500_000.0).select("o_orderkey")


def channel_enrichment(spark: SparkSession, d: str) -> DataFrame:
    links = _words(spark, d).where("channel IS NOT NULL").select(F.concat(F.lit("https://video.example/watch?v="), F.regexp_replace("source_video", r"\.[^.]*$", "")).alias("url"), "channel", F.col("clip_id").alias("row_pos"))
    return queue.channel_of(_reporter_rows(spark, d), links).groupBy("channel").agg(F.count("*").alias("n"))


def height_classes(spark: SparkSession, d: str) -> DataFrame:
    r = _reporter_rows(spark, d)
    cache = r.where("face_height_px IS NOT NULL").groupBy(F.col("source_video").alias("id")).agg(F.max("face_height_px").alias("height"))
    return queue.height_class(r, cache, "source_video", 300).groupBy("height_class").agg(F.count("*").alias("n"))


def pending_sources(spark: SparkSession, d: str) -> DataFrame:
    w = _words(spark, d).select("source_clip").where("source_clip IS NOT NULL").distinct()
    return queue.without_done(w, table(spark, d, "reporter_clips").select(F.col("clip_file").alias("source_clip")), ["source_clip"])


def committed_rows(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "reporter_clips").select(F.col("clip_file").alias("source_clip"))
    return queue.committed_only(_words(spark, d), done, "source_clip").groupBy("split").agg(F.count("*").alias("n"))


def journal_replay(spark: SparkSession, d: str) -> DataFrame:
    """Verified word clips replaced by their halves, all-wrong ones by nothing; the journal's earlier lines said otherwise."""
    v = table(spark, d, "verified").where("clip_id IS NOT NULL").groupBy("clip_id").agg(F.max("verified").alias("ok"))
    new = F.when(F.col("ok") == 1, F.array(F.concat("clip_id", F.lit("_a")), F.concat("clip_id", F.lit("_b")))).otherwise(F.array().cast("array<string>"))
    late = v.select(F.col("clip_id").alias("old"), new.alias("new"), F.lit(7).alias("ordinal"))
    early = v.select(F.col("clip_id").alias("old"), F.array(F.concat("clip_id", F.lit("_x"))).alias("new"), F.lit(3).alias("ordinal"))
    j = late.unionByName(early)
    return queue.replay_journal(_clips(spark, d).select("clip_id"), j, "clip_id")


def orphan_files(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "reporter_clips").select(F.col("clip_file").alias("path")).where("path IS NOT NULL").distinct()
    return queue.deletion_plan(files, table(spark, d, "word_clips").select(F.col("source_clip").alias("path")))


def segment_validation(spark: SparkSession, d: str) -> DataFrame:
    r = _reporter_rows(spark, d).select("clip_file", F.concat(F.lit(""), F.col("start_sec").cast("string")).alias("s"), F.when(F.col("duration_sec") > 4, F.col("end_sec").cast("string")).otherwise("").alias("e"))
    return queue.validate_segments(r, "s", "e").groupBy("reason").agg(F.count("*").alias("n"))


# --- agreement and release --------------------------------------------------------------------------


def kappa(spark: SparkSession, d: str) -> DataFrame:
    return agreement.cohen_kappa(agreement.annotator_pairs(_verdicts(spark, d)), ["kind", "a", "b"])


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return agreement.confusion(agreement.annotator_pairs(_verdicts(spark, d)), ["kind"])


def verified_items(spark: SparkSession, d: str) -> DataFrame:
    return agreement.verified_items(_verdicts(spark, d))


def corrected_truth(spark: SparkSession, d: str) -> DataFrame:
    t = lambda c: F.format_string("%.2f", F.col(c))
    q = _words(spark, d).select("clip_id", t("word_start_sec").alias("auto_start_sec"), t("word_end_sec").alias("auto_end_sec"), "surface")
    c = table(spark, d, "verified").where("verified = 1").select("clip_id").distinct().join(q.drop("surface").distinct(), "clip_id").withColumn("present", F.lit(1))
    return agreement.corrected_truth(q, c).groupBy("surface").agg(F.count("*").alias("n"))


def release_words(spark: SparkSession, d: str) -> DataFrame:
    labels = vocab.labelled(_words(spark, d), {"surface": "surface", "lemma": "lemma_cls"}, _vocab(spark, d))
    return release.release_words(labels, table(spark, d, "verified"))


# --- statistics -------------------------------------------------------------------------------------


def confidence_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram(_words(spark, d), F.col("confidence"), "split", stats.edges(0, 1, 0.05))


def height_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return stats.quantiles(_words(spark, d), F.col("face_height_px"), ["split"], [0.05, 0.5, 0.95])


def split_shares(spark: SparkSession, d: str) -> DataFrame:
    return stats.shares(_words(spark, d), F.col("split"), "split")


def rollup_total(spark: SparkSession, d: str) -> DataFrame:
    return stats.with_total(table(spark, d, "lineitem"), "l_returnflag", {"n": F.count("*"), "qty": F.round(F.sum("l_quantity"), 2)})


def distributions(spark: SparkSession, d: str) -> DataFrame:
    return stats.distributions(_words(spark, d).where("surface <> ''"), {"letters": F.length("surface"), "syllables": text.syllables("surface")}, F.col("surface"))


def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.pair_counts(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


def speaker_stats(spark: SparkSession, d: str) -> DataFrame:
    w = vocab.in_vocabulary(_words(spark, d), "lemma_cls", _vocab(spark, d).select("class"), "inl")
    return stats.speaker_table(w.where("speaker_id IS NOT NULL"), F.coalesce(F.col("track_ok") == 1, F.lit(False)), F.col("inl") == 1, F.col("inl") == 1).drop("words_in_vocab_surface")


def index_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return stats.index_percentiles(table(spark, d, "word_clips"), "face_height_px")


def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return sync.threshold_sweep(table(spark, d, "word_clips").where("word_sync_conf IS NOT NULL"), F.col("word_sync_conf"), F.coalesce(F.col("track_ok") == 1, F.lit(False)))


def shortest_per_reporter(spark: SparkSession, d: str) -> DataFrame:
    r = _reporter_rows(spark, d).where("duration_sec > 0 AND reporter IS NOT NULL")
    return r.groupBy("reporter").agg(F.min_by("clip_file", F.struct("duration_sec", "clip_file")).alias("clip_file"), F.min("duration_sec").alias("duration_sec"))


def progress_counts(spark: SparkSession, d: str) -> DataFrame:
    r = _reporter_rows(spark, d)
    return r.groupBy("reporter").agg(F.count("*").alias("n"), F.count_if(F.col("face_height_px") >= 300).alias("tall"), F.round(F.sum("duration_sec") / 3600, 6).alias("hours"))


# --- combinatorial, sync, graph ----------------------------------------------------------------------


def components(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("nation"), F.col("n_regionkey").cast("string").alias("region"))
    return graph.bipartite_components(n, "nation", "region")


def _split_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("unit"), F.col("c_nationkey").alias("class"))
    units = c.groupBy("unit").agg(F.count("*").alias("n"))
    pairs = splitsearch.combo_pairs(splitsearch.unit_combos(units, 2, 0.15, 0.45), 0.2)
    return splitsearch.classes_left(pairs, c.groupBy("unit", "class").agg(F.count("*").alias("n")), 1)


def split_search(spark: SparkSession, d: str) -> DataFrame:
    return _split_pairs(spark, d).select(F.array_join("test", "|").alias("test"), F.array_join("val", "|").alias("val"), F.round("test_share", 6).alias("test_share"), F.round("val_share", 6).alias("val_share"), "classes")


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("label", "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return e.select("label", (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).alias("i"), "v")


def offset_distances(spark: SparkSession, d: str) -> DataFrame:
    v = cut(_vectors(spark, d))
    return sync.offset_distances(v, v, ["label"], "i", "v", 3, 0.0).select("label", "i", "offset", F.round("dist", 4).alias("dist"))


def best_offsets(spark: SparkSession, d: str) -> DataFrame:
    v = cut(_vectors(spark, d))
    b = sync.best_offset(sync.offset_distances(v, v, ["label"], "i", "v", 3, 0.0), ["label"], 5)
    return b.select("label", "offset", F.round("min_dist", 4).alias("min_dist"), F.round("confidence", 4).alias("confidence"))


def offset_distances_whole(spark: SparkSession, d: str) -> DataFrame:
    """The search with the operator's own reach."""
    v = cut(_vectors(spark, d))
    return sync.offset_distances(v, v, ["label"], "i", "v").select("label", "i", "offset", F.round("dist", 4).alias("dist"))


def best_offsets_whole(spark: SparkSession, d: str) -> DataFrame:
    """The search with the operator's own reach and least number of frames."""
    v = cut(_vectors(spark, d))
    b = sync.best_offset(sync.offset_distances(v, v, ["label"], "i", "v"), ["label"])
    return b.select("label", "offset", F.round("min_dist", 4).alias("min_dist"), F.round("confidence", 4).alias("confidence"))


# --- scalar families, items ------------------------------------------------------------------------------


def video_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "reporter_clips").groupBy(urls.video_id("source_url").alias("video_id"), urls.normalize_url("source_url").alias("url")).agg(F.count("*").alias("n"))


def time_forms(spark: SparkSession, d: str) -> DataFrame:
    r = _reporter_rows(spark, d)
    return r.select("clip_file", timing.format_hms("end_sec").alias("hms"), timing.format_seconds("start_sec").alias("sec"), timing.parse_time(timing.format_hms("end_sec")).alias("parsed"), timing.frame_of("start_sec").alias("frame"))


def span_frames(spark: SparkSession, d: str) -> DataFrame:
    s = timing.span_frames(F.col("word_start_sec") - F.col("clip_start_sec"), F.col("word_end_sec") - F.col("clip_start_sec"), "n_frames", F.coalesce("syncnet_offset", F.lit(0)))
    w = table(spark, d, "word_clips").select((s["f1"] - s["f0"]).cast("int").alias("frames"))
    return w.groupBy("frames").agg(F.count("*").alias("n"))


def media_names(spark: SparkSession, d: str) -> DataFrame:
    c = _clips(spark, d)
    return c.select("clip_id", ids.media_name("clip_id", "split").alias("media"), ids.stem_of("source_clip").alias("stem"), ids.release_path("source_clip").alias("path"))


def item_names(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("frame_start")
    return table(spark, d, "word_clips").select("clip_id", ids.word_item_id("speaker_id", i).alias("word_id"), ids.sentence_item_id("speaker_id", i, F.when(i > 100, i % 3)).alias("sentence_id"), text.safe_name("surface_form").alias("safe")).distinct()


def json_props(spark: SparkSession, d: str) -> DataFrame:
    p = F.from_json("props", "k int")
    return _events(spark, d).groupBy("event_type").agg(F.sum(p["k"]).alias("k"), F.count_if(p["k"].isNull()).alias("unknown"))


def box_shifts(spark: SparkSession, d: str) -> DataFrame:
    """Shift of a word's mouth box against the next one of its source clip, boxes made from the manifest's columns."""
    w = table(spark, d, "word_clips").where("mouth_width_px IS NOT NULL AND face_height_px IS NOT NULL AND clip_id IS NOT NULL").groupBy("clip_id").agg(F.max("mean_yaw").alias("x"), F.max("mean_pitch").alias("y"), F.max("mouth_width_px").alias("w"), F.max("face_height_px").cast("double").alias("h"), F.max("source_clip").alias("source_clip"))
    w = w.withColumn("box", F.struct("x", "y", "w", "h")).withColumn("other", seq.after("box", ["source_clip"], ["clip_id"]))
    return w.select("clip_id", F.round(geometry.centre_shift(F.col("box"), F.col("other"), F.lit(2.0), F.lit(3.0)), 6).alias("shift"), F.round(geometry.yaw_ratio(F.lit(0.0), F.col("x"), F.col("w")), 6).alias("yaw"))


def suffix_join(spark: SparkSession, d: str) -> DataFrame:
    s = spotting.spans(_sentences(spark, d)).withColumn("confidence", F.when(F.col("pos") % 4 != 3, F.lit(0.6) + F.col("pos") % 5 / 20)).withColumn("manual_review", F.coalesce(items.manual_review("confidence"), F.lit(0)))
    j = items.join_suffixes(s, ["clip_id"], "pos")
    return items.number_words(j, "clip_id", ["pos"]).select("clip_id", "pos", "surface_form", "lemma", "start_sec", "end_sec", F.round("confidence", 4).alias("confidence"), "manual_review", "word_index")


def word_gates(spark: SparkSession, d: str) -> DataFrame:
    w = _words(spark, d)
    s = timing.span_frames(F.col("word_start_sec") - F.col("clip_start_sec"), F.col("word_end_sec") - F.col("clip_start_sec"), "n_frames")
    g = items.word_gate(F.col("word_end_sec") - F.col("word_start_sec"), s, F.coalesce(F.col("track_ok") == 1, F.lit(False)), F.col("word_sync_conf"), F.col("lip_motion"), min_motion=0.05)
    return w.groupBy(g.alias("reason")).agg(F.count("*").alias("n"))


def sentence_gates(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sentence_clips")
    failed = F.when(F.coalesce("sentence_sync_conf", F.lit(9.0)) < 3, F.col("n_words")).otherwise(0)
    g = items.sentence_gate(F.col("sentence_end_sec") - F.col("sentence_start_sec"), F.col("n_frames") > 0, F.coalesce(F.col("syncnet_score") >= 2, F.lit(True)), failed, F.col("n_words"))
    return s.groupBy(g.alias("reason")).agg(F.count("*").alias("n"))


def clip_gates(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "word_clips").groupBy("source_clip").agg(F.count("surface_form").alias("words"), F.max("n_frames").alias("frames"), F.max("syncnet_score").alias("score"))
    return w.groupBy(items.clip_gate(F.col("words"), F.col("frames"), F.col("score")).alias("status")).agg(F.count("*").alias("n"))


def transcript_slice(spark: SparkSession, d: str) -> DataFrame:
    s = _sentences(spark, d).withColumn("ws", F.from_json("word_spans", f"array<{SPAN}>")).where("ws IS NOT NULL")
    cutout = items.slice_transcript(F.array(F.struct(F.col("ws").alias("words"))), F.lit(1.0), F.lit(3.0))
    one = s.select("clip_id", F.explode(cutout).alias("x"))
    return one.select("clip_id", F.round("x.start_sec", 3).alias("start_sec"), F.round("x.end_sec", 3).alias("end_sec"), "x.text", F.size("x.words").alias("n_words"))


def pause_split(spark: SparkSession, d: str) -> DataFrame:
    s = _sentences(spark, d).withColumn("words", F.from_json("word_spans", f"array<{SPAN}>")).where("words IS NOT NULL")
    return items.split_sentences(s, "clip_id")


def donor_clips(spark: SparkSession, d: str) -> DataFrame:
    r = _reporter_rows(spark, d).where("duration_sec IS NOT NULL AND reporter IS NOT NULL").select("clip_file", "reporter", "duration_sec")
    return sync.donors(r, "reporter", "duration_sec", "clip_file")


def speaker_sets(spark: SparkSession, d: str) -> DataFrame:
    """Speakers of the words against the speaker table: in both, only in words, only in the table."""
    a = _words(spark, d).select("speaker_id").where("speaker_id IS NOT NULL").distinct()
    b = table(spark, d, "speaker_table").select(text.clean_key("speaker_id").alias("speaker_id")).where("speaker_id IS NOT NULL").distinct()
    tag = lambda df, n: df.select("speaker_id", F.lit(n).alias("side"))
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "words")).unionByName(tag(b.subtract(a), "table"))


_NAMES = (
    token_classes, vocab_surface, vocab_lemma, vocab_removals, class_split_dense, in_vocab_flags, top_share, class_ranks, quality_rules, quality_reasons, small_faces, empty_profile, item_checks,
    channel_leak, lemma_fallbacks, lemma_backfill, lemma_choice, train_cap, stratified_sample, annotator_assignment, per_class_sample, global_sample, round_robin, rank_slice, rarest_classes,
    interleaved, spotting_queries, spotting_negatives, spotting_classes, spotting_clamped, broken_spans, occurrence_labels, annotation_tasks, recent_rates, idle_users, track_islands, forward_filled, centred_stats, median_filtered, short_holes_filled,
    spread_counts, jumps, smoothed, padded_windows, pauses, last_session, change_points, chunk_tiles, sessions, hourly_counts, streamed_words, queue_selection, greedy_overlap, merged_speakers,
    merge_counts, zero_clip_rows, stable_order, budget_stop, channel_enrichment, height_classes, pending_sources, committed_rows, journal_replay, orphan_files, segment_validation, kappa,
    confusion, verified_items, corrected_truth, release_words, confidence_histogram, height_quantiles, split_shares, rollup_total, distributions, pair_counts, speaker_stats, index_percentiles,
    threshold_sweep, shortest_per_reporter, progress_counts, components, split_search, offset_distances, best_offsets, offset_distances_whole, best_offsets_whole, video_ids, time_forms, span_frames, media_names, item_names, json_props,
    box_shifts, suffix_join, word_gates, sentence_gates, clip_gates, transcript_slice, pause_split, donor_clips, speaker_sets,
)


def queries() -> dict:
    return {
        **{f.__name__: f for f in _NAMES},
        **extra.queries(),
        "p7_found": hotkeys.p7_found,
        "p7_speakers": hotkeys.p7_speakers,
        "p7_reporters": hotkeys.p7_reporters,
    }

