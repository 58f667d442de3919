import random

import pytest

from clipwright.llm import consensus as c
from tests.conftest import rows
from tests.llm.helpers import at, write_all


def answers(spark, data):
    return spark.createDataFrame(data, "kind string, clip_id string, annotator string, verdict string, label_fix string")


def simulated(seed=3, items=400):
    """Two careful annotators, one careless, one who always says correct, one who swaps two classes."""
    r = random.Random(seed)
    truth, data = {}, []
    swap = {"wrong_word": "offscreen", "offscreen": "wrong_word"}
    for i in range(items):
        t = r.choices(c.VERDICTS, [6, 2, 1, 1])[0]
        truth[f"c{i}"] = t
        for who in ("good1", "good2", "noisy", "yes1", "yes2", "swapper"):
            if r.random() < 0.35:
                continue
            p = {"good1": 0.96, "good2": 0.94, "noisy": 0.5}.get(who)
            v = "correct" if who.startswith("yes") else swap.get(t, t) if who == "swapper" else t if r.random() < p else r.choice(c.VERDICTS)
            data.append(("word", f"c{i}", who, v, None))
    return truth, data


def test_weighs_annotators(spark):
    truth, data = simulated()
    model = c.fit(answers(spark, data))
    got = {r["clip_id"]: r["verdict"] for r in model.items.collect()}
    votes = {}
    for _, clip, _, v, _ in data:
        votes.setdefault(clip, []).append(v)
    majority = sum(max(set(v), key=v.count) == truth[k] for k, v in votes.items()) / len(votes)
    ours = sum(got[k] == truth[k] for k in got) / len(got)
    assert ours > 0.9 and ours > majority + 0.05
    skill = {r["annotator"]: r["ability"] for r in model.annotators.collect()}
    assert min(skill["good1"]) > max(skill["yes1"][1:]) and skill["swapper"][1] < 0


def test_joined_parameters_give_the_same(spark):
    _, data = simulated(items=120)
    a, b = c.fit(answers(spark, data)), c.fit(answers(spark, data), max_broadcast=2)
    assert rows(a.items, "clip_id", "verdict") == rows(b.items, "clip_id", "verdict")
    skill = {r["annotator"]: r["ability"] for r in b.annotators.select("annotator", "ability").distinct().collect()}
    assert len(skill) == a.annotators.count()
    for r in a.annotators.collect():
        assert skill[r["annotator"]] == pytest.approx(r["ability"], abs=1e-6)


def test_unsettled_model_is_an_error(spark):
    _, data = simulated(items=60)
    for limit in (c.MAX_BROADCAST_ANNOTATORS, 2):
        with pytest.raises(RuntimeError):
            c.fit(answers(spark, data), max_broadcast=limit, passes=2)


def test_weighted_patterns_equal_single_items(spark):
    """A hundred copies of every item move the abilities like the copies themselves."""
    _, data = simulated(items=30)
    many = [(k, f"{clip}_{n}", a, v, f) for k, clip, a, v, f in data for n in range(20)]
    model = c.fit(answers(spark, many))
    got = {r["clip_id"]: r["verdict"] for r in model.items.collect()}
    assert len(got) == 20 * len({x[1] for x in data})
    assert all(len({got[f"{clip}_{n}"] for n in range(20)}) == 1 for clip in {x[1] for x in data})


def test_counted_answers_and_fixes(spark, tmp_path):
    base = dict(kind="word", clip_id="c1", was_cancelled=False, export_file="f")
    data = [
        dict(base, annotation_id=1, annotator=" A1", verdict="Wrong Word", label_fix=" Ev, ", created_at=at(1)),
        dict(base, annotation_id=2, annotator="a1", verdict="correct", created_at=at(2), was_cancelled=True),
        dict(base, annotation_id=3, annotator="a2", verdict="wrong_word", label_fix="еv", created_at=at(1)),  # a Cyrillic letter
        dict(base, annotation_id=4, annotator="a3", verdict="wrong_word", label_fix="at", created_at=at(1)),
        dict(base, annotation_id=5, annotator="a3", verdict="wrong_word", label_fix="at", created_at=at(1)),
        dict(base, annotation_id=6, annotator="a4", verdict=" ", created_at=at(1)),
        dict(base, annotation_id=7, annotator="a5", verdict="unsure", created_at=at(1)),
        dict(base, clip_id="c2", annotation_id=8, annotator="a1", verdict="unsure", created_at=at(1)),
        dict(base, clip_id="c3", annotation_id=9, annotator="a1", verdict="wrong_word", label_fix="x", created_at=at(1)),
        dict(base, clip_id="c3", annotation_id=10, annotator="a2", verdict="wrong_word", label_fix="y", created_at=at(1)),
        dict(base, clip_id=None, annotation_id=11, annotator="a2", verdict="correct", created_at=at(1)),
        dict(base, clip_id="c4", annotation_id=12, annotator=None, verdict="correct", created_at=at(1)),
    ]
    d = write_all(spark, tmp_path / "t", annotations=data)
    got = rows(c.p1_found(spark, d))
    assert ("word", "c1", "label_fix", "ev") in got and ("word", "c1", "verdict", "wrong_word") in got
    assert not [r for r in got if r[1] in ("c2", None)] and not [r for r in got if r[1] == "c3" and r[2] == "label_fix"]
    assert ("word", "c4", "verdict", "correct") in got


@pytest.mark.parametrize("n", [0, 1])
def test_tiny(spark, n):
    a = answers(spark, [("word", "c", "x", "offscreen", None)][:n])
    assert c.fit(a).items.count() == n
