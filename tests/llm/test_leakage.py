import random

import pytest

from clipwright.llm import leakage as k
from tests.conftest import rows


def vocabulary(n=400, seed=4):
    r = random.Random(seed)
    return ["".join(r.choice("bcdfgklmnprstvyzçğşöüıiaeou") for _ in range(r.randint(3, 9))) for _ in range(n)]


def test_words():
    t = "<p>1\n00:00:01,000 --> 00:00:02,000\nİlk’in <b>SÖZÜ</b>, iki<br/>\n\n2\n00:00:02,100 --> 00:00:03,000\nsÃ¶z 5'te ｖｅ</p>"
    assert k.words_of(t) == (["ilkin", "sözü", "iki", "söz", "5te", "ve"], False)
    assert k.words_of(None) == ([], False) and k.words_of("...") == ([], False)


def test_against_brute_force(spark):
    r, v = random.Random(9), vocabulary()
    passages = [(i, " ".join(r.choice(v) for _ in range(r.choice([7, 8, 9, 12, 30])))) for i in range(60)]
    docs = []
    for i in range(400):
        words = [r.choice(v) for _ in range(r.randint(0, 80))]
        if i % 3 == 0:
            w = r.choice(passages)[1].split()
            n = r.choice([6, 9, 10, 11, len(w)])
            a = r.randint(0, max(0, len(w) - n))
            at = r.randint(0, len(words))
            words[at:at] = w[a : a + n]
        text = ", ".join(words) if i % 2 else " ".join(words).replace("i", "İ").replace("ı", "I").upper()
        docs.append((i, text.encode().decode("latin-1") if i % 9 == 0 and i % 2 else text, "x"))
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, " ".join([passages[0][1]] * 2000), "x")]
    p = spark.createDataFrame([*passages, (99, None), (98, "!"), (97, passages[3][1])], "item_id bigint, text string")
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string").repartition(3)
    got = set(rows(k.leaks(d, p)))
    grams = {}
    for i, t in [*passages, (97, passages[3][1])]:
        w = k.words_of(t)[0]
        n = min(10, len(w))
        for a in range(len(w) - n + 1):
            grams.setdefault(tuple(w[a : a + n]), set()).add(i)
    want = set()
    for i, t, _ in docs:
        w = k.words_of(t)[0]
        for n in {len(g) for g in grams}:
            for a in range(len(w) - n + 1):
                want |= {(i, x) for x in grams.get(tuple(w[a : a + n]), ())}
    assert got == want and len(want) > 50
    assert set(rows(k.leaks(d, p, block_words=200))) == want


def test_lost_characters_still_match(spark):
    t = "gördüğün ışık çok şaşırtıcı geldi bana dün akşam yemekte söyledim"
    p = spark.createDataFrame([(1, t)], "item_id bigint, text string")
    lost = "".join(c if c.isascii() else "�" * len(c.encode()) for c in t)
    d = spark.createDataFrame([(1, "önce " + lost + " sonra"), (2, t.replace("bana", "sana"))], "doc_id bigint, text string")
    assert rows(k.leaks(d, p)) == [(1, 1)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[-1] + 1))
    return row[-1]


def edited(r, words, n, v):
    w = list(words)
    for _ in range(n):
        at = r.randrange(len(w))
        kind = r.choice("rid")
        if kind == "r":
            w[at] = r.choice(v)
        elif kind == "i":
            w.insert(at, r.choice(v))
        else:
            del w[at]
    return w


def planted(r, v, size, edits, n=400):
    items = [(i, [r.choice(v) for _ in range(size)]) for i in range(n)]
    texts = [[*(r.choice(v) for _ in range(20)), *edited(r, w, edits, v), *(r.choice(v) for _ in range(20))] for _, w in items]
    return items, texts


@pytest.mark.parametrize("size,edits,least", [(10, 0, 1.0), (10, 1, 0.95), (10, 2, 0.9), (5, 1, 0.9), (7, 1, 0.93), (14, 2, 0.97), (43, 8, 0.99)])
def test_recall_on_planted_edits(size, edits, least):
    r, v = random.Random(size * 10 + edits), vocabulary(3000)
    items, texts = planted(r, v, size, edits)
    found = {(x, o): e for x, o, e, _, _ in k.PassageIndex([(i, " ".join(w)) for i, w in items]).search(texts)}
    assert sum((i, i) in found for i, _ in items) >= least * len(items)
    # Nothing is reported that is not there: some stretch of the text is as near as said.
    for (x, o), e in list(found.items())[:10]:
        t, w = texts[x], items[o][1]
        n = min(10, len(w))
        least = min(distance(w[q : q + n], t[p : p + m]) for q in range(len(w) - n + 1) for p in range(len(t)) for m in range(n - k.allowed(n), n + k.allowed(n) + 1))
        assert least <= e <= k.allowed(n)


def test_edits_words_and_whole():
    r, v = random.Random(3), vocabulary(2000)
    w = [r.choice(v) for _ in range(30)]
    changed = [*w[:9], "bambaska", *w[10:]]
    texts = [w, changed, ["bir", "iki", *w[5:17], "son"], w[:9], []]
    got = {x: (e, n, whole) for x, _, e, n, whole in k.PassageIndex([(7, " ".join(w))]).search(texts)}
    assert got[0] == (0, 30, 0) and got[1] == (0, 30, 1) and got[2][0] == 0 and 12 <= got[2][1] <= 16 and got[2][2] is None and got[3][0] == 1 and 4 not in got
    fourteen = w[:14]
    near = {x: (e, whole) for x, _, e, _, whole in k.PassageIndex([(1, " ".join(fourteen))]).search([[*fourteen[:9], "baska", *fourteen[10:]], [*fourteen[:7], fourteen[7] + "x", *fourteen[8:]]])}
    assert near == {0: (1, 1), 1: (1, 1)}


def test_index_is_small():
    import pickle

    r, v = random.Random(5), vocabulary(3000)
    index = k.PassageIndex([(i, " ".join(r.choice(v) for _ in range(51))) for i in range(240)])
    assert len(pickle.dumps(index)) < 5_000_000


def test_near_in_blocks(spark):
    r, v = random.Random(12), vocabulary(2000)
    items, texts = planted(r, v, 12, 2, 60)
    p = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    once = rows(k.near_passages(d, p))
    assert once == rows(k.near_passages(d, p, block_words=100)) and len(once) >= 57
