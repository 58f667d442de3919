import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from clipwright.functions import geometry, ids, text, timing, urls


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize("given, want", [("İIĞ", "iığ"), ("", ""), (None, None)])
def test_turkish_lower(spark, given, want):
    assert one(spark, given, text.turkish_lower) == want


@pytest.mark.parametrize("given, want", [("“karar,’", "karar"), ("--", ""), ("a-b", "a-b"), (None, None)])
def test_strip_edges(spark, given, want):
    assert one(spark, given, text.strip_edges) == want


@pytest.mark.parametrize("given, want", [("'nin", False), ("’da", False), ("...", False), ("NA", True), ("null", True), ("Ankara'da", True)])
def test_has_label(spark, given, want):
    assert one(spark, given, text.has_label) is want


def test_small_text_keys(spark):
    assert one(spark, "rüzgâr", text.circumflex_fold) == "rüzgar"
    assert one(spark, "...", text.lemma_fallback) == "..."
    assert one(spark, "“Kâr”", text.lemma_fallback) == "kar"
    assert one(spark, "karanlık", text.syllables) == 3
    assert one(spark, "жук", text.is_latin) is False and one(spark, "çok-1", text.is_latin) is True
    assert one(spark, "٣", text.has_digit) is True
    assert one(spark, " SPK_1 ", text.clean_key) == "spk_1" and one(spark, " - ", lambda c: text.clean_key(c, "-")) is None
    assert one(spark, "..a b/c..", text.safe_name) == "a_b_c" and one(spark, "...", text.safe_name) == "unnamed"


@pytest.mark.parametrize("given, want", [("1:02:03", 3723.0), ("2:03", 123.0), ("7.5", 7.5), ("", None), ("a:b", None), ("1:2:3:4", None)])
def test_parse_time(spark, given, want):
    assert one(spark, given, timing.parse_time) == want


@pytest.mark.parametrize("given, want", [(0.02, 0), (0.06, 2), (0.10, 2)])
def test_frames_round_half_even(spark, given, want):
    assert one(spark, given, timing.frame_of, "double") == want


def test_spans(spark):
    df = spark.createDataFrame([(1.9, 2.0, 50, 3), (0.0, 0.0, 25, 0), (None, 1.0, 25, 0)], "s double, e double, n int, off int")
    got = [r[0] and tuple(r[0]) for r in df.select(timing.span_frames("s", "e", "n", "off")).collect()]
    assert got == [None, (0, 1), None]
    o = spark.createDataFrame([(-0.1, 0.0, 25)], "s double, e double, n int").select(timing.occurrence_frames("s", "e", "n").alias("o")).first()[0]
    assert (o["start_sec"], o["end_sec"], o["f0"], o["f1"], o["clamped"]) == (0.0, 0.0, 0, 1, True)


def test_time_forms(spark):
    assert one(spark, 3722.2, timing.format_hms, "double") == "01:02:03"
    assert one(spark, 5.0, timing.format_seconds, "double") == "5" and one(spark, 5.25, timing.format_seconds, "double") == "5.25"


@pytest.mark.parametrize("given, want", [("youtu.be/abcdefghijk?t=1", "abcdefghijk"), ("https://youtube.com/shorts/abcdefghijk", "abcdefghijk"), ("example.org/x", None), (None, None)])
def test_video_id(spark, given, want):
    assert one(spark, given, urls.video_id) == want


def test_normalize_url(spark):
    assert one(spark, "https://www.video.example/watch?v=abcdefghijk&t=5s", urls.normalize_url) == "https://video.example/watch?v=abcdefghijk"
    assert one(spark, "kisa.example/abcdefghijk", urls.normalize_url) == "https://video.example/watch?v=abcdefghijk"
    assert one(spark, "http://m.Other.example/a/?q=1", urls.normalize_url) == "https://other.example/a"


def test_ids(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert df.select(ids.media_name("x", "y")).first()[0] == hashlib.sha1(b"a|b").hexdigest()[:16]
    assert df.select(ids.group_seed("x", "y")).first()[0] == zlib.crc32(b"a/b")
    assert df.select(ids.hash_rank(7, "x")).first()[0] == hashlib.md5(b"7#a").hexdigest()
    assert df.select(ids.word_item_id("x", F.lit(3)), ids.sentence_item_id("x", F.lit(3), F.lit(1)), ids.stem_of(F.lit("d/e.f.mp4")), ids.release_path(F.lit("data\\a\\b.npz"))).first()[:] == ("a_w0003", "a_s003_1", "e.f", "a/b.npz")


def test_geometry(spark):
    box = lambda x, w: F.struct(F.lit(x).alias("x"), F.lit(0.0).alias("y"), F.lit(w).alias("w"), F.lit(0.2).alias("h"))
    df = spark.range(1)
    assert df.select(geometry.centre_shift(box(0.1, 0.2), box(0.3, 0.2), F.lit(100), F.lit(100))).first()[0] == pytest.approx(1.0)
    assert df.select(geometry.yaw_ratio(F.lit(0.0), F.lit(1.0), F.lit(4.0))).first()[0] == pytest.approx(0.5)
    assert df.select(geometry.yaw_ratio(F.lit(0.0), F.lit(0.0), F.lit(0.0))).first()[0] == 1.0
    assert df.select(geometry.distance(F.array(F.lit(0.0), F.lit(3.0)), F.array(F.lit(4.0), F.lit(0.0)))).first()[0] == 5.0
    assert tuple(df.select(geometry.bottom_square(F.lit(10), F.lit(0), F.lit(20), F.lit(90), F.lit(100), F.lit(80))).first()[0]) == (10, 60, 30, 80)
