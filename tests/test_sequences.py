import pytest
from pyspark.sql import functions as F

from clipwright.operators import items, seq
from tests.conftest import rows

FACE = "array<struct<score:double,x:double,y:double,w:double,h:double,dist:double,yaw:double>>"


def series(spark, statuses, **more):
    data = [("c", k, s, *(v[k] for v in more.values())) for k, s in enumerate(statuses)]
    return spark.createDataFrame(data, "c string, k int, status int" + "".join(f", {n} int" for n in more))


def status(df):
    return [r[0] for r in df.orderBy("k").select("status").collect()]


@pytest.mark.parametrize("given, want", [([0, 1, 1, 0], [0, 0, 0, 0]), ([0, 1, 1, 1, 0], [0, 1, 1, 1, 0]), ([1, 0], [1, 0]), ([0, 1, 2], [0, 1, 2])])
def test_short_holes(spark, given, want):
    assert status(seq.fill_short_runs(series(spark, given), ["c"], ["k"], "status", 1, 0)) == want


def test_head_counts_spread_both_ways(spark):
    heads = [1, None, None, None, None, 2, None, None, None, None, 1, None]
    got = status(seq.spread_counts(series(spark, [0] * 12, heads=heads), ["c"], ["k"], "status", "heads", 0, 2))
    assert got == [0] + [2] * 9 + [0, 0]


def test_padded_window(spark):
    f = series(spark, [1 if k in (10, 50) else 0 for k in range(60)])
    spans = spark.createDataFrame([("c", 20, 25)], "c string, f0 int, f1 int")
    assert rows(seq.padded_windows(f, spans, ["c"], "k", F.col("status") == 0), "a", "b", "full_pad") == [(11, 40, False)]
    f = series(spark, [0] * 30)
    spans = spark.createDataFrame([("c", 2, 5)], "c string, f0 int, f1 int")
    assert rows(seq.padded_windows(f, spans, ["c"], "k", F.col("status") == 0), "a", "b", "full_pad") == [(0, 20, True)]


def test_median_filter_pads_with_zeros(spark):
    df = spark.createDataFrame([("c", k, float(k + 1)) for k in range(9)], "c string, k int, v double")
    got = [r[0] for r in df.select("k", seq.median_filter(F.col("v"), ["c"], ["k"], 9).alias("m")).orderBy("k").select("m").collect()]
    assert got == [1.0, 2.0, 3.0, 4.0, 5.0, 5.0, 5.0, 5.0, 5.0]


def records(spark, n, face=lambda k: (0.9, 0.4, 0.3, 0.2, 0.4, 0.3, 0.1), extra=()):
    data = []
    for k in range(n):
        faces = [face(k)] + ([(0.9, 0.1, 0.1, 0.1, 0.2, 0.9, 0.1)] if k in extra else [])
        data.append(("v", round(k * 0.2, 3), 1000, 1000, 1000, faces))
    return spark.createDataFrame(data, f"video string, t double, src_h int, frame_h int, frame_w int, faces {FACE}")


def scenes(spark, end):
    return spark.createDataFrame([("v", 0, 0.0, end)], "video string, scene_index int, start_sec double, end_sec double")


def test_solo_segments(spark):
    assert seq.solo_segments(records(spark, 21, extra=(10,)), scenes(spark, 4.0)).count() == 0
    got = seq.solo_segments(records(spark, 51), scenes(spark, 10.0)).collect()
    assert len(got) == 1 and got[0]["start_sec"] == pytest.approx(0.3) and got[0]["end_sec"] == pytest.approx(9.7) and got[0]["face_height_px"] == 400
    unknown = records(spark, 51, face=lambda k: (0.9, 0.4, 0.3, 0.2, 0.4, None, 0.1))
    assert seq.solo_segments(unknown, scenes(spark, 10.0)).count() == 0
    # The identity vote is per track: one bad sample does not cut it.
    vote = records(spark, 51, face=lambda k: (0.9, 0.4, 0.3, 0.2, 0.4, 0.83 if k == 20 else 0.58, 0.1))
    assert seq.solo_segments(vote, scenes(spark, 10.0)).count() == 1


def test_last_session(spark):
    df = spark.createDataFrame([("a", t) for t in (0, 10, 1000, 1010, 1020)], "k string, s int").select("k", F.timestamp_seconds("s").alias("at"))
    assert seq.last_session(df, ["k"], "at", 600.0).count() == 3


def test_suffixes_join(spark):
    w = [("d", 0, 0, "Ankara", "ankara", 0.0, 1.0, 0.9, 0), ("d", 0, 1, "'da", "da", 1.0, 1.2, 0.6, 1), ("d", 0, 2, "'ki", "ki", 1.2, 1.4, None, 0), ("d", 1, 0, "'ın", "ın", 2.0, 2.1, 0.8, 0), ("d", 1, 1, "ev", "ev", 2.1, 2.3, 0.8, 0)]
    df = spark.createDataFrame(w, "d string, seg int, idx int, surface_form string, lemma string, start_sec double, end_sec double, confidence double, manual_review int")
    got = rows(items.join_suffixes(df, ["d", "seg"]), "seg", "idx", "surface_form", "confidence", "manual_review", "end_sec")
    assert got == [(0, 0, "Ankara'da'ki", 0.6, 1, 1.4), (1, 0, "'ın", 0.8, 0, 2.1), (1, 1, "ev", 0.8, 0, 2.3)]


def test_word_gate_lets_unknown_confidence_pass(spark):
    df = spark.createDataFrame([("ev", None), ("ev", 1.0), ("жук", 9.0), ("'da", 9.0), ("...", 9.0)], "surface_form string, conf double")
    g = items.word_gate(F.lit(0.5), F.struct(F.lit(1)), F.lit(True), F.col("conf"))
    assert [r[0] for r in df.select(g).collect()] == [None, "offscreen_speech", "non_latin_label", "suffix_fragment", "empty_label"]


def test_sentence_gate(spark):
    df = spark.createDataFrame([(3, 10), (4, 10), (0, 0)], "failed int, judged int")
    g = items.sentence_gate(F.lit(2.0), F.lit(True), F.lit(True), F.col("failed"), F.col("judged"))
    assert [r[0] for r in df.select(g).collect()] == [None, "offscreen_speech", None]


def test_pause_split():
    assert items.pause_split([(0.0, 9.0)]) == [(0, 1)]
    assert items.pause_split([(0.0, 4.0), (4.5, 5.0), (6.0, 9.0)]) == [(0, 2), (2, 3)]
    words = [(float(k), k + 0.9) for k in range(20)]
    parts = items.pause_split(words)
    assert parts[0][0] == 0 and parts[-1][1] == 20 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert all(words[j - 1][1] - words[i][0] <= 8 for i, j in parts)


def test_transcript_slice(spark):
    doc = [("v", [(0.0, 3.0, "x", [("a", "a", 0.0, 0.9, 0.9, 0), ("b", "b", 1.0, 1.5, 0.9, 0), ("c", "c", 1.6, 2.4, 0.9, 0)]), (3.0, 4.0, "y", [("d", "d", 3.0, 3.5, 0.9, 0)])])]
    from clipwright.schemas import TRANSCRIPT

    df = spark.createDataFrame(doc, TRANSCRIPT)
    got = df.select(items.slice_transcript(F.col("segments"), F.lit(1.0), F.lit(2.5)).alias("s")).first()[0]
    assert [(s["text"], s["start_sec"], s["end_sec"]) for s in got] == [("b c", 0.0, 1.4)]
