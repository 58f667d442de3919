"""From transcripts to word and sentence items: joins of suffixes, gates with reasons, pause splits."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_latin, is_suffix, lemma_fallback, strip_edges
from .quality import first_reason
from .seq import islands

REVIEW_BELOW = 0.7


def manual_review(confidence: Column | str) -> Column:
    c = F.col(confidence) if isinstance(confidence, str) else confidence
    return (c < REVIEW_BELOW).cast("int")


def transcript_words(transcripts: DataFrame, doc: str = "video") -> DataFrame:
    """One row per word: (doc, seg, idx, surface_form, lemma, start_sec, end_sec, confidence, manual_review), positions kept."""
    seg = transcripts.select(doc, F.posexplode("segments").alias("seg", "s"))
    return seg.select(doc, "seg", F.posexplode("s.words").alias("idx", "w")).select(doc, "seg", "idx", "w.*")


def join_suffixes(words: DataFrame, keys: list[str], idx: str = "idx") -> DataFrame:
    """Join apostrophe suffixes to the word before them, chains included; a leading suffix stays alone.

    Times span the run, confidence is the least known, the review flag and the lemma are made anew
    for joined words.
    """
    w = Window.partitionBy(*keys).orderBy(idx)
    starts = (F.row_number().over(w) == 1) | ~F.coalesce(is_suffix("surface_form"), F.lit(False))
    marked = words.withColumn("_new", starts)
    run = islands(marked, keys, [idx], F.col("_new"), "_run")
    g = run.groupBy(*keys, "_run").agg(
        F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), "surface_form", "lemma", "manual_review"))).alias("ws"),
        F.min(idx).alias(idx), F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"), F.min("confidence").alias("confidence"),
    )
    surface = F.array_join(F.transform("ws", lambda x: x["surface_form"]), "")
    joined = F.size("ws") > 1
    return g.select(
        *keys, idx, surface.alias("surface_form"), F.when(joined, lemma_fallback(surface)).otherwise(F.col("ws")[0]["lemma"]).alias("lemma"), "start_sec", "end_sec", "confidence",
        F.when(joined, manual_review("confidence")).otherwise(F.col("ws")[0]["manual_review"]).alias("manual_review"),
    )


def number_words(words: DataFrame, clip: str, order: list[str]) -> DataFrame:
    """Running index over all words of a clip, dropped ones included."""
    return words.withColumn("word_index", F.row_number().over(Window.partitionBy(clip).orderBy(*order)) - 1)


def word_gate(length: Column, frames: Column, all_good: Column, conf: Column, motion: Column | None = None, max_sec: float = 2.0, min_conf: float = 2.5, min_motion: float | None = None) -> Column:
    """The first reason to drop a word, in order; an unknown confidence passes."""
    label = F.col("surface_form")
    bare = F.coalesce(strip_edges(label), F.lit("")) == ""
    rules = [
        ("empty_label", bare), ("suffix_fragment", is_suffix(label)), ("non_latin_label", ~is_latin(label)), ("word_too_long", length > max_sec),
        ("out_of_range", frames.isNull()), ("track_fail", ~all_good), ("offscreen_speech", conf < min_conf),
    ]
    if motion is not None and min_motion is not None:
        rules.append(("offscreen_speech", motion < min_motion))
    return first_reason(rules)


def sentence_gate(length: Column, in_range: Column, all_good: Column, failed: Column, judged: Column, lo: float = 1.0, hi: float = 8.0, max_failed: float = 0.3) -> Column:
    """Judged are the words that reached the sync gate; the share of failed ones must exceed the limit to drop the sentence."""
    share = F.when(judged > 0, failed / judged)
    return first_reason([("duration", ~length.between(lo, hi)), ("out_of_range", ~in_range), ("track_fail", ~all_good), ("offscreen_speech", share > max_failed)])


def clip_gate(words: Column, sync_frames: Column, score: Column, least: float = 3.0) -> Column:
    return F.coalesce(first_reason([("no_words", F.coalesce(words, F.lit(0)) == 0), ("too_short_for_sync", F.coalesce(sync_frames, F.lit(0)) <= 35), ("low_sync", score < least)]), F.lit("ok"))


def slice_transcript(segments: Column, a: Column, b: Column) -> Column:
    """Words wholly inside [a, b], times counted from a, texts made anew, empty segments dropped."""
    inside = lambda s: F.filter(s["words"], lambda w: (w["start_sec"] >= a) & (w["end_sec"] <= b))
    shift = lambda w: w.withField("start_sec", F.round(w["start_sec"] - a, 3)).withField("end_sec", F.round(w["end_sec"] - a, 3))
    kept = F.filter(F.transform(segments, lambda s: F.transform(inside(s), shift)), lambda ws: F.size(ws) > 0)
    return F.transform(
        kept,
        lambda ws: F.struct(
            F.element_at(ws, 1)["start_sec"].alias("start_sec"), F.element_at(ws, -1)["end_sec"].alias("end_sec"), F.array_join(F.transform(ws, lambda w: w["surface_form"]), " ").alias("text"), ws.alias("words")
        ),
    )


def pause_split(words: list[tuple[float, float]], longest: float = 8.0, zone: float = 0.5) -> list[tuple[int, int]]:
    """Cut a run of word times into parts [i, j) no longer than ``longest``, at pauses near the middle.

    Of the gaps whose left word ends near the middle (within ``zone`` of half the length) the widest
    is taken, the later of equals; without any, the gap nearest to the middle, the first of equals.
    Parts start and end at their own words, so a single long word stays whole.
    """
    out, todo = [], [(0, len(words))]
    while todo:
        i, j = todo.pop()
        start, end = words[i][0], words[j - 1][1]
        if end - start <= longest or j - i < 2:
            out.append((i, j))
            continue
        mid, reach = (start + end) / 2, (end - start) / 2 * zone
        gaps = range(i + 1, j)
        near = [k for k in gaps if abs(words[k - 1][1] - mid) <= reach]
        at = max(near, key=lambda k: (words[k][0] - words[k - 1][1], k)) if near else min(gaps, key=lambda k: (abs(words[k - 1][1] - mid), k))
        todo += [(at, j), (i, at)]
    return out


def split_sentences(sentences: DataFrame, key: str, words: str = "words") -> DataFrame:
    """(key, part, start_sec, end_sec, n_words, text) for sentences with ``words`` array<struct<surface_form, start_sec, end_sec>>.

    The recursion has no column form; it runs over Arrow batches, one sentence at a time.
    """

    def parts(pdfs: Iterator) -> Iterator:
        import pandas as pd

        for pdf in pdfs:
            rows = []
            for k, ws in zip(pdf["k"], pdf["w"]):
                ws = [w for w in (ws if ws is not None else []) if w["start_sec"] is not None and w["end_sec"] is not None]
                if not ws:
                    continue
                times = [(w["start_sec"], w["end_sec"]) for w in ws]
                for n, (i, j) in enumerate(pause_split(times)):
                    rows.append((k, n, times[i][0], times[j - 1][1], j - i, " ".join(w["surface_form"] or "" for w in ws[i:j])))
            yield pd.DataFrame(rows, columns=["k", "part", "start_sec", "end_sec", "n_words", "text"])

    out = sentences.select(F.col(key).alias("k"), F.col(words).alias("w")).mapInPandas(parts, "k string, part int, start_sec double, end_sec double, n_words int, text string")
    return out.withColumnRenamed("k", key)


def segment_bounds(start: Column, end: Column, words: Column) -> Column:
    """struct(start_sec, end_sec) of a segment widened to its first and last word."""
    first, last = F.get(words, F.lit(0))["start_sec"], F.element_at(words, -1)["end_sec"]
    some = F.size(words) > 0
    return F.struct(F.when(some, F.least(start, first)).otherwise(start).alias("start_sec"), F.when(some, F.greatest(end, last)).otherwise(end).alias("end_sec"))


def rebased_spans(words: Column, offset_frames: Column, first_frame: Column, fps: int = 25) -> Column:
    """Spans of words counted from a sentence's first frame, moved by the clip's offset."""
    by = offset_frames / fps - first_frame / fps
    at = lambda t: F.round(t + by, 3)
    return F.transform(words, lambda w: F.struct(w["surface_form"].alias("surface_form"), F.coalesce(F.nullif(w["lemma"], F.lit("")), w["surface_form"]).alias("lemma"), at(w["start_sec"]).alias("start_sec"), at(w["end_sec"]).alias("end_sec")))


def sentence_items(sentences: DataFrame, clip: str, n_frames: str, offset: str, lo: float = 1.0, hi: float = 8.0, fps: int = 25) -> DataFrame:
    """(clip, part, split_index, text, start_sec, end_sec, f0, f1, n_words, word_spans, reason) of sentences with text, start_sec, end_sec and words.

    A sentence is widened to its words and cut at pauses where it is too long; an uncut one keeps its text, a part joins its
    words. ``reason`` says why a part is no item: its duration, or no frame of the clip.
    """
    bounds = segment_bounds(F.col("start_sec"), F.col("end_sec"), F.col("words"))
    wide = sentences.withColumn("_b", bounds)
    parts = split_spans(wide.select(clip, F.col("_b.start_sec").alias("_s"), F.col("_b.end_sec").alias("_e"), "words"), clip)
    out = wide.drop("start_sec", "end_sec").join(parts, clip)
    f0 = F.bround(F.col("start_sec") * fps).cast("int") + F.col(offset)
    f1 = F.greatest(F.bround(F.col("end_sec") * fps).cast("int") + F.col(offset), f0 + 1)
    out = out.withColumn("f0", F.greatest(f0, F.lit(0))).withColumn("f1", F.least(f1, F.col(n_frames)))
    inside = F.slice("words", F.col("_i") + 1, F.col("_j") - F.col("_i"))
    many = F.col("_parts") > 1
    joined = F.array_join(F.transform(inside, lambda w: F.coalesce(w["surface_form"], F.lit(""))), " ")
    length = F.col("end_sec") - F.col("start_sec")
    reason = first_reason([("duration", ~length.between(lo, hi)), ("out_of_range", F.col("f0") >= F.col("f1"))])
    return out.select(
        clip, "part", F.when(many, F.col("part")).alias("split_index"), F.when(many, joined).otherwise(F.trim("text")).alias("text"), F.round("start_sec", 3).alias("start_sec"),
        F.round("end_sec", 3).alias("end_sec"), "f0", "f1", F.size(inside).alias("n_words"), F.to_json(rebased_spans(inside, F.col(offset), F.col("f0"), fps)).alias("word_spans"), reason.alias("reason"),
    )


def split_spans(sentences: DataFrame, key: str) -> DataFrame:
    """(key, part, start_sec, end_sec, _i, _j, _parts) for sentences (key, _s, _e, words): the first part keeps the sentence's start, the last its end."""

    def parts(pdfs: Iterator) -> Iterator:
        import pandas as pd

        for pdf in pdfs:
            rows = []
            for k, s, e, ws in zip(pdf["k"], pdf["_s"], pdf["_e"], pdf["w"]):
                times = [(w["start_sec"], w["end_sec"]) for w in (ws if ws is not None else [])]
                if not times:
                    rows.append((k, 0, s, e, 0, 0, 1))
                    continue
                times[0] = (s, times[0][1])
                times[-1] = (times[-1][0], e)
                cuts = pause_split(times)
                rows += [(k, n, times[i][0], times[j - 1][1], i, j, len(cuts)) for n, (i, j) in enumerate(cuts)]
            yield pd.DataFrame(rows, columns=["k", "part", "start_sec", "end_sec", "_i", "_j", "_parts"])

    kind = sentences.schema[key].dataType.simpleString()
    out = sentences.select(F.col(key).alias("k"), "_s", "_e", F.col("words").alias("w")).mapInPandas(parts, f"k {kind}, part int, start_sec double, end_sec double, _i int, _j int, _parts int")
    return out.withColumnRenamed("k", key)


def transcript_counts(transcripts: DataFrame, doc: str = "video") -> DataFrame:
    """(doc, segments, words) of nested transcripts."""
    n = F.aggregate("segments", F.lit(0), lambda acc, s: acc + F.coalesce(F.size(s["words"]), F.lit(0)))
    return transcripts.select(doc, F.coalesce(F.size("segments"), F.lit(0)).alias("segments"), F.coalesce(n, F.lit(0)).alias("words"))
