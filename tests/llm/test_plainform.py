import pytest

from clipwright.llm import plainform as p
from tests.conftest import rows
from tests.llm.helpers import at, write_all

CASES = [
    (None, None, False),
    ("", "", False),
    ("şöyle “bir” ’söz’… 5", "şöyle “bir” ’söz’… 5", False),
    ("ｖｅ", "ve", True),
    ("ve​", "ve", True),
    ("iki söz", "iki söz", True),
    ("şöz", "şöz", True),
    ("ș", "ş", True),
    ("ci̇rez", "cirez", True),
    ("vе", "ve", True),
    ("νar", "var", True),
    ("шипуга ve", "шипуга ve", False),
    ("Ramu'уа", "Ramu'ya", True),
    ("июлька'da", "июлька'da", False),
    ("ﬁl", "fil", True),
    ("cúmüș", "cúmüş", True),
    ("gaşəmol νə", "gaşəmol və", True),
    ("²", "2", True),
]


@pytest.mark.parametrize("given, plain, strange", CASES)
def test_forms(spark, given, plain, strange):
    got = p.with_plain_form(spark.createDataFrame([(given,)], "v string"), "v").first()
    assert (got["plain"], got["strange"]) == (plain, strange)
    if given is not None:
        assert p.plain_text(given) == plain


def test_lookup_join_equals_direct(spark):
    df = spark.createDataFrame([(g,) for g, *_ in CASES] * 2, "v string")
    assert rows(p.to_plain(df, "v")) == sorted([(w,) for _, w, _ in CASES] * 2, key=str)


def test_long_text_and_columns(spark):
    long = "ｖｅ " * 50_000
    df = spark.createDataFrame([(1, long, "keep", "old")], "k int, v string, x string, plain string")
    got = p.with_plain_form(df, "v").first()
    assert got["plain"] == "ve " * 50_000 and got["x"] == "keep" and got["k"] == 1


def test_latest_row_decides(spark, tmp_path):
    w = [dict(clip_id="a", surface_form="ｖｅ", appended_at=at(1)), dict(clip_id="a", surface_form="ve", appended_at=at(2)), dict(clip_id="b", surface_form="ｖｅ", appended_at=at(1)), dict(clip_id="b", surface_form="ｖｅ", appended_at=at(1)), dict(clip_id="c", surface_form="ｖｅ")]
    d = write_all(spark, tmp_path / "t", word_clips=w, sentence_clips=[dict(clip_id="s", text="bir şey", appended_at=at(1))])
    assert rows(p.p4_found(spark, d)) == [("sentence_clips", "s"), ("word_clips", "b"), ("word_clips", "c")]


def test_every_longer_form(spark):
    more = p.compatibility()[1]
    given = [*more, *(f"bir\n{k}ki {k}" for k in "ĳ㎏⑴⒈ﬁǆ"), "".join(more)]
    df = spark.createDataFrame([(g,) for g in given], "v string")
    got = {r["v"]: (r["plain"], r["strange"]) for r in p.with_plain_form(df, "v").collect()}
    assert got == {g: (p.plain_text(g), True) for g in given}
    assert got["㎏"][0] == "kg" and got["ĳ"][0] == "ij" and got["⑴"][0] == "(1)" and got["⒈"][0] == "1."
