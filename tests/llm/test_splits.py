from clipwright.llm import cross_split as x
from clipwright.llm import splits as s
from tests.conftest import SF, rows
from tests.llm.helpers import at, write_all


def test_ties(spark, tmp_path):
    w = [dict(clip_id=f"c{i}", speaker_id=a, channel=b, appended_at=at(i)) for i, (a, b) in enumerate([(" S1", "K1 "), ("s2", "k1"), ("s2", "k2"), ("s3", "K2"), ("s4", "k9"), ("s5", "-"), ("s6", "-"), ("s7", None), (None, "k1"), ("", "bilinmiyor")])]
    d = write_all(spark, tmp_path / "t", word_clips=w + w[:2])
    assert rows(s.p2_found(spark, d)) == [("s1", "s1"), ("s2", "s1"), ("s3", "s1")]
    got = s.p2_splits(spark, d).collect()
    assert {r["clip_id"] for r in got} == {f"c{i}" for i in range(10)} and len(got) == 10
    assert {r["unit_id"] for r in got if r["clip_id"] in ("c0", "c1", "c2", "c3", "c8")} == {"s1"}


def test_split_is_whole_and_near_targets(spark):
    got = s.p2_splits(spark, SF).toPandas()
    assert got.groupby("unit_id").split.nunique().max() == 1
    units = spark.createDataFrame([(f"u{i % 700}", f"l{i % 5}") for i in range(20_000)], "unit string, label string")
    for large in (0.0001, 0.5):
        a = s.assign(units, "unit", "label", large=large).toPandas()
        share = a.groupby("split")["rows"].sum() / a["rows"].sum()
        assert abs(share["train"] - 0.8) < 0.03 and abs(share["val"] - 0.1) < 0.03 and abs(share["test"] - 0.1) < 0.03 and len(a) == 700


def test_every_label_counts(spark):
    import numpy as np

    data = [(f"u{i:03d}", f"l{(i * 7 + j * j) % 150}") for i in range(100) for j in range(60 + i)]
    df = spark.createDataFrame(data, "unit string, label string")
    a = s.assign(df, "unit", "label").toPandas()
    share = a.groupby("split")["rows"].sum() / len(data)
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["val"] - 0.1) < 0.02 and abs(share["test"] - 0.1) < 0.02
    x = np.zeros((100, 150))
    for u, k in data:
        x[int(u[1:]), int(k[1:])] += 1
    hist = df.groupBy("unit", "label").agg(s.F.count("*").alias("c"))
    at = spark.createDataFrame([(f"u{i:03d}", i) for i in range(100)], "unit string, i int")
    assert np.allclose(s._overlap(hist, at, 100), (x / np.maximum(x.sum(0), 1)) @ x.T)
    # Units of two halves of rare labels: no half may go to one split whole.
    two = spark.createDataFrame([(f"{i:02d}{h}", f"{h}{j}") for h in "ab" for i in range(40) for j in range(100)], "unit string, label string")
    got = s.assign(two, "unit", "label").toPandas()
    by = got.groupby([got.unit.str[2], "split"])["rows"].sum().unstack(fill_value=0) / 4000
    assert (abs(by["train"] - 0.8) < 0.06).all() and (abs(by["val"] - 0.1) < 0.06).all() and (abs(by["test"] - 0.1) < 0.06).all()


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, p in enumerate(a, 1):
        cur = [i]
        for j, q in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (p != q)))
        prev = cur
    return prev[-1]


def test_near_classes_against_brute_force(spark):
    import random

    r = random.Random(5)
    vocab = [f"w{i}" for i in range(30)]
    base = [[r.choice(vocab) for _ in range(r.randint(8, 22))] for _ in range(60)]
    data = []
    for i, t in enumerate(base):
        data.append((f"t{i}", t, True, i % 9 == 0))
        e = list(t)
        for _ in range(r.randint(0, 5)):
            k = r.randrange(len(e))
            op = r.random()
            e = e[:k] + e[k + 1 :] if op < 0.4 and len(e) > 8 else e[:k] + [r.choice(vocab)] + e[k + (op < 0.7) :]
        data.append((f"e{i}", e, False, True))
    df = spark.createDataFrame(data, "cid string, terms array<string>, has_train boolean, has_eval boolean")
    got = set(rows(x.near_classes(df)))
    want = {(a[0], b[0]) for a in data if a[3] for b in data if b[2] if distance(a[1], b[1]) <= max(len(a[1]), len(b[1])) // 5}
    assert got == want and len(want) > 20


def test_pairs(spark, tmp_path):
    t = "bir iki üç dört beş altı yedi sekiz dokuz on"
    sent = [("a", "v1", t), ("b", "t1", t.replace("i", "İ").upper() + "!"), ("c", "t1", t.replace("beş", "ｂｅş").replace("üç", "on")), ("d", "t1", t.replace("üç", "x").replace("on", "y").replace("bir", "z")), ("e", "n1", t), ("f", "v1", "kısa söz"), ("g", "t1", None)]
    words = [dict(clip_id="w1", source_clip="v1", split="val", appended_at=at(0)), dict(clip_id="w2", source_clip="t1", split="train", appended_at=at(0)), dict(clip_id="w3", source_clip="t1", split=None, appended_at=at(0)), dict(clip_id="w4", source_clip="n1", split=None, appended_at=at(0))]
    rows_ = [dict(clip_id=c, source_clip=s_, text=v, channel="K1", appended_at=at(1)) for c, s_, v in sent] + [dict(clip_id="d", source_clip="t1", text="x", appended_at=at(0))]
    d = write_all(spark, tmp_path / "t", word_clips=words, sentence_clips=rows_)
    assert rows(x.p3_found(spark, d)) == [("a", "b"), ("a", "c")]
    assert rows(x.p3_report(spark, d)) == [("val", "k1", 2, 1)]
    assert [(r[0], r[2], r[3]) for r in rows(x.p3_classes(spark, d))] == [("a", "eval", 2), ("b", "train", 1), ("c", "train", 1)]


def test_edit_limit(spark):
    many = [f"t{i}" for i in range(300)]
    pairs = [(list("abcdefghij"), list("abcdefghij")), (list("abcdefghij"), list("abXdefgYij")), (list("abcdefghij"), list("abXdefgYZj")), (many, many[60:]), (many, many[61:]), ([], [])]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    assert [r[0] for r in df.select(x._within(x.F.col("a"), x.F.col("b"))).collect()] == [True, True, False, True, False, True]
