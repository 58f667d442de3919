"""Manifests of any size, read in splits."""

import itertools
import random
import time

import pytest

from clipwright.plans import extra
from clipwright.sources import manifests
from tests.conftest import rows
from tests.test_queries import compare
from tests.test_round_r02 import odd_table

FIELDS = {"fps": "string", "clip_id": "string", "t": "string"}
HEAD = "clip_id,t,fps,more\n"


def expected(text):
    """The rows and the count of bad ones, sign by sign."""
    done, row, field, raw, state = [], [], "", "", "begin"
    clean = text if text.endswith("\n") else text[: text.rfind("\n") + 1]
    for c in clean:
        raw += c
        if state == "inside":
            state, field = ("closing", field) if c == '"' else (state, field + c)
        elif c == '"' and state in ("begin", "closing"):
            field += '"' if state == "closing" else ""
            state = "inside"
        elif c == ",":
            row, field, state = [*row, field], "", "begin"
        elif c == "\n":
            row = [*row, field.removesuffix("\r") if raw.endswith("\r\n") else field]
            done, row, field, raw, state = [*done, (row, raw.strip(" \t\r\n"))], [], "", "", "begin"
        else:
            field, state = field + c, "plain"
    cut = clean != text or bool(raw)
    good, bad = [], int(cut)
    for pos, (r, signs) in enumerate(done):
        if pos and len(r) <= 4 and signs:
            clip, t, fps, _ = r + [""] * (4 - len(r))
            if not clip or "\0" in clip or not fps:
                bad += 1
            else:
                good.append((fps, clip, t, pos))
    return sorted(good, key=str), bad


def read(spark, path, data, split):
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        good, bad = manifests.read_manifest(spark, str(path), FIELDS)
        return rows(good, "fps", "clip_id", "t", "row_pos"), bad.first()[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("seed", range(6))
def test_manifest_over_splits(spark, tmp_path, seed):
    rnd = random.Random(seed)
    plain = lambda: "".join(rnd.choice(["a", "\u015f", " ", "\t", "\r", '"', "\U0001f600", "\0"]) for _ in range(rnd.randrange(4)))
    quoted = lambda: '"' + "".join(rnd.choice(["a", ",", "\n", "\r\n", '""', "\u0131", "\0"]) for _ in range(rnd.choice([0, 2, 5, 90]))) + '"' + rnd.choice(["", "", "", "x"])
    field = lambda: rnd.choice([lambda: "b" + plain(), quoted, lambda: "", lambda: "25"])()
    lines = [",".join(field() for _ in range(rnd.choice([4, 4, 4, 4, 1, 2, 3, 5]))) + rnd.choice(["\n", "\r\n"]) for _ in range(90)]
    text = HEAD + "".join(lines) + rnd.choice(["", "\0\0", 'torn,"ha\nlf', "torn", 'torn,"\n', "\n\n \n", ',"\n",,\0\0\n'])
    want = expected(text)
    assert len(want[0]) > 5
    for split in (len(text) // 9, 1 << 20):
        assert read(spark, tmp_path / f"{split}.csv", text, split) == want


@pytest.mark.parametrize(
    "text, good, bad",
    [
        ("", [], 0),
        ("\0\0\0", [], 1),
        ("clip_id,t,f", [], 1),
        ("clip_id,t,f\0\0", [], 1),
        (HEAD, [], 0),
        ("\ufeff" + HEAD + "a,b,25,\n", [("25", "a", "b", 1)], 0),
        (HEAD + 'a,"b\r\nc",25,\r\n', [("25", "a", "b\r\nc", 1)], 0),
        (HEAD + 'a,b,25,"x\ny', [], 1),
        (HEAD + "a,b,25\n\nb,,25,x,y\nc\n", [("25", "a", "b", 1)], 1),
        (HEAD + 'a,5" b,25,\nb,"5"" c",25,\n', [("25", "a", '5" b', 1), ("25", "b", '5" c', 2)], 0),
        (HEAD + "a,b,25,x\0\n", [("25", "a", "b", 1)], 0),
    ],
)
def test_odd_manifests(spark, tmp_path, text, good, bad):
    for split in (max(7, len(text) // 3), 1 << 20):
        assert read(spark, tmp_path / f"{split}.csv", text, split) == (good, bad)


def test_manifest_torn_inside_a_character(spark, tmp_path):
    assert read(spark, tmp_path / "m.csv", HEAD.encode() + "a,\u015f,25,\nb,\u015f".encode()[:-1], 1 << 20) == ([("25", "a", "\u015f", 1)], 1)


def test_manifest_of_many_and_of_long_rows(spark, tmp_path):
    many = HEAD + "".join(f'c{i},"{"a b" * 40}\n",25,\n' for i in range(20_000)) + 'l,"' + '"",\n' * 200_000 + '",25,\n'
    began = time.perf_counter()
    good, bad = read(spark, tmp_path / "m.csv", many, 200_000)
    assert len(good) == 20_001 and bad == 0 and max(len(r[2]) for r in good) == 600_000
    assert time.perf_counter() - began < 60


def test_manifest_roundtrip_of_odd_texts(spark, tmp_path):
    signs = [" ", "\n", "\r", "\r\n", '"', ",", "\\", "\x00", "\ufeff", "\u0131", "\U0001f600", "a", ""]
    odd = ["".join(p) for p in itertools.product(signs, repeat=3)]
    given = [{"clip_file": o, "transcript_text": None if i % 7 == 0 else odd[-1 - i], "face_height_px": None if i % 5 == 0 else i % 3} for i, o in enumerate(odd)]
    given += [{"clip_file": None, "transcript_text": "x", "face_height_px": 1}, {"clip_file": "long", "transcript_text": '" ,\n' * 100_000, "face_height_px": 1}]
    sf = odd_table(spark, tmp_path, "reporter_clips", given)
    compare(spark, extra.manifest_roundtrip, extra.oracle_sql()["manifest_roundtrip"], sf)


def test_manifest_roundtrip_of_no_rows(spark, tmp_path):
    sf = odd_table(spark, tmp_path, "reporter_clips", [])
    compare(spark, extra.manifest_roundtrip, extra.oracle_sql()["manifest_roundtrip"], sf)
