"""Queries against their SQL on odd inputs."""

import datetime
import itertools
import json
import time

import pytest

from clipwright.operators import agreement
from clipwright.plans import extra
from clipwright.sources import manifests, sinks
from tests.conftest import SF, rows
from tests.test_queries import compare


def odd_table(spark, tmp_path, name, given):
    """A table with the columns of the test tables, the given ones filled in and the others null."""
    schema = spark.read.parquet(f"{SF}/{name}.parquet").schema
    spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in given], schema).coalesce(2).write.parquet(str(tmp_path / "spark"))
    (tmp_path / "tables").mkdir()
    import duckdb

    duckdb.sql(f"COPY (FROM '{tmp_path}/spark/*.parquet') TO '{tmp_path}/tables/{name}.parquet' (FORMAT parquet)")
    return str(tmp_path / "tables")


def test_exports_keep_every_answer(spark, tmp_path):
    who = [None, "", " ", "a", "Ay\u015fe \"x\"", "b\\c", "a\nb", "[1]", "7"]
    fixes = [None, "", " ", "\u00a0\u2003", "ev ", "\u00a0ev", "[]", "x\ty", "\U0001f600"]
    given = [
        {"annotation_id": i, "export_file": ("a", "b", "", "c/d", None)[i % 5], "kind": ("word", "sentence", None)[i % 3], "clip_id": None if i % 17 == 0 else f"c{i}", "annotator": who[i % 9],
         "verdict": ("correct", "wrong_word ", "", None, "CORRECT", "[x]")[i % 7 % 6], "label_fix": fixes[i // 2 % 9], "was_cancelled": (None, False, False, True)[i % 4], "created_at": datetime.datetime(2024, 1, 1)}
        for i in range(400)
    ]
    sf = odd_table(spark, tmp_path, "annotations", given)
    compare(spark, extra.exports_roundtrip, extra.oracle_sql()["exports_roundtrip"], sf)


def test_exports_of_no_answers(spark, tmp_path):
    sf = odd_table(spark, tmp_path, "annotations", [])
    assert extra.exports_roundtrip(spark, sf).count() == 0


@pytest.mark.parametrize("sep, whole", [(",", True), ("\n", False), ("]\n[", False)])
def test_exports_are_read_whole_or_refused(spark, tmp_path, sep, whole):
    task = lambda n: json.dumps({"data": {"kind": "word", "clip_id": n}, "annotations": [{"completed_by": None, "result": [{"from_name": "verdict", "value": {"choices": ["correct"]}}]}]})
    body = sep.join(map(task, "ab"))
    (tmp_path / "t.json").write_text(body if sep == "\n" else f"\ufeff \n[{body}]\n", encoding="utf-8")
    if whole:
        assert rows(agreement.flatten_exports(manifests.read_exports(spark, str(tmp_path))), "clip_id", "annotator") == [("a", "t:"), ("b", "t:")]
    else:
        with pytest.raises(ValueError):
            manifests.read_exports(spark, str(tmp_path))


def test_normalized_text_of_odd_texts(spark, tmp_path):
    edges = [" ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2009", "\u2028", "\u2029", "\u202f", "\u3000", "\u200b", "\ufeff", ""]
    texts = [None, "", " ", "a", "\xe9", "e\u0301", "\u0130", "I\u0307", "\u015f", "s\u0327", "\uac00", "\u1100\u1161", "\u212b", "a\u0323\u0307", "a\u0307\u0323", "a  b", "e\u0301 \n\n c", "\U0001f600", "x\xa0y", "\u0301"]
    given = [{"clip_id": f"c{i}{j}", "text": t if t is None else e + t + e + f} for i, e in enumerate(edges) for j, t in enumerate(texts) for f in ("", " ", "\u2029\n")]
    sf = odd_table(spark, tmp_path, "sentence_clips", given)
    compare(spark, extra.normalized_text, extra.oracle_sql()["normalized_text"], sf)


@pytest.mark.parametrize("given, want", [([], []), ([None, None], [("", 2)]), ([" a", "a", None], [("", 1), ("a", 2)]), (["\xe9" + " " * 200_000 + "x "], [("\xe9" + " " * 200_000 + "x", 1)])])
def test_normalized_text_of_few_texts(spark, tmp_path, given, want):
    sf = odd_table(spark, tmp_path, "sentence_clips", [{"text": t} for t in given])
    began = time.perf_counter()
    assert rows(extra.normalized_text(spark, sf)) == want
    assert time.perf_counter() - began < 60


def test_csv_keeps_every_character(spark, tmp_path):
    signs = [" ", "\n", "\r", "\r\n", "\t", '"', ",", "\\", "#", "\x00", "\u00a0", "\ufeff", "\u0131", "a", ""]
    odd = ["".join(p) for p in itertools.product(signs, repeat=3)]
    given = [{"clip_id": f"{i} ", "text": t, "word_spans": None if i % 7 == 0 else odd[-1 - i], "n_words": None if i % 5 == 0 else -i} for i, t in enumerate(odd)]
    given += [{"clip_id": "", "text": ""}, {"clip_id": "", "text": " "}, {"clip_id": None, "text": "a"}, {"clip_id": "a", "text": None}, {"clip_id": "long", "text": '" ,\n' * 100_000, "word_spans": "[ "}]
    sf = odd_table(spark, tmp_path, "sentence_clips", given)
    compare(spark, extra.csv_roundtrip, extra.oracle_sql()["csv_roundtrip"], sf)


def test_csv_of_no_rows_and_of_a_session_that_splits_files(spark, tmp_path):
    sf = odd_table(spark, tmp_path, "sentence_clips", [])
    assert extra.csv_roundtrip(spark, sf).count() == 0
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        sinks.export_csv(spark.range(9), str(tmp_path / "n.csv"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert manifests.read_csv(spark, str(tmp_path / "n.csv"), {"id": "string"}).count() == 9
