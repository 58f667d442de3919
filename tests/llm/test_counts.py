import random

from clipwright.llm import caps, frequency, packing
from tests.conftest import rows
from tests.llm.helpers import at, write_all


def test_cap(spark, tmp_path):
    w = [dict(clip_id=f"c{i:02d}", speaker_id=" Big" if i % 2 else "big", channel="k", confidence=[0.5, None, 0.9, 0.5][i % 4], appended_at=at(i)) for i in range(30)]
    w += [dict(clip_id=f"o{i:02d}", speaker_id=f"s{i}", channel=None, confidence=0.5, appended_at=at(i)) for i in range(30)] + [dict(clip_id=f"n{i}", speaker_id=None, appended_at=at(i)) for i in range(40)]
    w += [dict(clip_id="c00", speaker_id="big", confidence=0.1, appended_at=at(99))]
    d = write_all(spark, tmp_path / "t", word_clips=w)
    gone = {r[0] for r in rows(caps.p5_found(spark, d))}
    kept = sorted(f"c{i:02d}" for i in range(30) if f"c{i:02d}" not in gone)
    assert kept == ["c02", "c06", "c10", "c14", "c18"] and not [g for g in gone if g[0] != "c"]
    assert {r[0] for r in rows(caps.p5_nested(spark, d, author=0.2, domain=0.1))} >= {f"c{i:02d}" for i in range(1, 30, 4)}


def test_nested_is_greedy(spark):
    r = random.Random(2)
    data = [(f"i{i:03d}", f"a{r.randrange(4)}", f"d{r.randrange(2)}", r.randrange(5) / 4) for i in range(300)]
    df = spark.createDataFrame(data, "clip_id string, author string, domain string, score double")
    gone = {x[0] for x in rows(caps.nested_caps(df, [(["domain", "author"], 20), (["domain"], 50)], "clip_id", "score"))}
    per, dom, want = {}, {}, set()
    for i, a, d, _ in sorted(data, key=lambda x: (-x[3], x[0])):
        if per.get((d, a), 0) < 20 and dom.get(d, 0) < 50:
            per[(d, a)], dom[d] = per.get((d, a), 0) + 1, dom.get(d, 0) + 1
        else:
            want.add(i)
    assert gone == want


def test_terms(spark, tmp_path):
    w = []
    for i in range(10):
        w.append(dict(clip_id=f"c{i}", surface_form=["Ev,", "ｅv", "EV"][i % 3], lemma="ev", speaker_id=f"s{i % 3}", source_clip=f"v{i % 4}", appended_at=at(i)))
    w += [dict(clip_id="x1", surface_form="az", lemma="...", speaker_id="s1", source_clip="v9", appended_at=at(1)), dict(clip_id="x1", surface_form="az", lemma="", speaker_id="s1", source_clip="v9", appended_at=at(2)), dict(clip_id="x2", surface_form=None, lemma=None, appended_at=at(1))]
    listed = [dict(lemma="Ev", rank=1, count=10, speakers=3), dict(lemma="yok", rank=2, count=4, speakers=1), dict(lemma="hiç", rank=3, count=0, speakers=0)]
    d = write_all(spark, tmp_path / "t", word_clips=w, lemma_classes_605=listed)
    assert rows(frequency.p6_terms(spark, d)) == [("lemma", "ev", 10, 3, 4), ("surface_form", "az", 1, 1, 1), ("surface_form", "ev", 10, 3, 4)]
    assert rows(frequency.p6_found(spark, d)) == [("lemma", "ev", "common"), ("lemma", "yok", "stale"), ("surface_form", "az", "rare"), ("surface_form", "ev", "common")]


def test_block_arrays(spark, monkeypatch):
    data = [(int(i), i % 3, 1) for i in range(20_000)] + [(5, 0, 7)] * 50
    got = rows(frequency.counted(spark.createDataFrame(data, "id bigint, kind int, n bigint").repartition(3)))
    assert len(got) == 20_000 and (5, 350, 0, 1) in got and (9, 1, 0, 0) in got
    ids = frequency.dictionary(spark.createDataFrame([(f"t{i % 500:04d}",) for i in range(2000)], "t string"), ["t"])
    assert rows(ids, "t", "id") == [(f"t{i:04d}", i) for i in range(500)]


def test_a_hot_term_is_not_shuffled(spark):
    data = [("lemma", "ev" if i % 3 else f"t{i}", f"s{i % 40}") for i in range(3000)]
    df = spark.createDataFrame(data, "field string, term string, speaker string").repartition(4)
    terms = frequency.cut(frequency.dictionary(df, ["field", "term"]))
    ids = {r["term"]: r["id"] for r in terms.collect()}
    for heavy in (0.5, 0.001, 1.1):  # one heavy term, all, none
        assert rows(frequency.encoded(df, terms, heavy)) == sorted((((s, ids[t]) for _, t, s in data)), key=str)
    plan = frequency.encoded(df, terms)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_first_fit_decreasing():
    r = random.Random(1)
    for n in (0, 1, 7, 200):
        sizes = [r.randint(0, 100) for _ in range(n)]
        got = packing.first_fit_decreasing(sizes, 100)
        room, want = [], [0] * n
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            k = next((k for k, x in enumerate(room) if x >= sizes[i]), None)
            if k is None:
                room.append(100)
                k = len(room) - 1
            room[k] -= sizes[i]
            want[i] = k
        assert got == want


def test_containers(spark, tmp_path):
    docs = [dict(doc_id=1, text="söz " * 3000), dict(doc_id=2, text=None), dict(doc_id=3, text=""), *(dict(doc_id=10 + i, text="bir iki üç " * (20 + i)) for i in range(40))]
    d = write_all(spark, tmp_path / "t", documents=docs)
    got = packing.p8_containers(spark, d, capacity=512).toPandas()
    assert got.groupby("container").tokens.sum().max() <= 512 and set(got.doc_id) == {x["doc_id"] for x in docs}
    long = got[got.doc_id == 1].sort_values("piece")
    assert len(long) > 1 and (long.tokens[:-1] == 512).all()
    assert (got[got.doc_id != 1].groupby("doc_id").size() == 1).all()


def test_groups_keep_bins_apart(spark):
    pieces = spark.createDataFrame([(i, 0, 1 + i % 900) for i in range(3000)], "id bigint, piece int, tokens bigint")
    got = packing.pack(pieces, 1000, group=500).toPandas()
    assert len(got) == 3000 and got.groupby("container").tokens.sum().max() <= 1000
    assert got.tokens.sum() / 1000 / got.container.nunique() > 0.95


def test_equal_and_null_ids_are_dealt_like_others(spark):
    pieces = spark.createDataFrame([(7 if i % 2 else None, 0, 1 + i % 90) for i in range(4000)], "id bigint, piece int, tokens bigint")
    got = packing.pack(pieces, 100, group=200).toPandas()
    assert len(got) == 4000 and got.groupby("container").tokens.sum().max() <= 100
    assert (got.container // 2**32).value_counts().max() < 400 and (got.container // 2**32).nunique() == 20
