import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipwright import schemas
from clipwright.operators import agreement, hotkeys, quality, queue, release, sampling, splitsearch, stats, sync, vocab
from clipwright.operators.graph import bipartite_components
from clipwright.sources import manifests, sinks
from clipwright.streaming import incremental
from tests.conftest import rows


def test_greedy_overlap(spark):
    df = spark.createDataFrame([(1, 0.0, 10.0), (2, 9.5, 20.0), (3, 9.0, 12.0), (4, 10.0, 15.0)], "pos int, s double, e double")
    assert rows(queue.greedy_overlap(df, F.lit("u"), "pos", "s", "e"), "pos", "kept") == [(1, True), (2, True), (3, False), (4, False)]
    whole = spark.createDataFrame([(1, None, None), (2, 0.0, 5.0)], "pos int, s double, e double")
    assert rows(queue.greedy_overlap(whole, F.lit("u"), "pos", "s", "e"), "pos", "kept") == [(1, True), (2, False)]


def test_queue_merge_and_reset(spark):
    base = spark.createDataFrame([("b",)], "id string")
    inc = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "id string, row_pos int")
    merged, counts = queue.merge_idempotent(base, inc, "id")
    assert rows(merged) == [("a",), ("b",)] and rows(counts) == [(1, 2, 1)]
    q = spark.createDataFrame([("x", "1"), (None, "1"), ("y", "1"), ("z", "")], "id string, completed string")
    clips = spark.createDataFrame([("y",)], "c string")
    assert rows(queue.zero_clip_rows(q, clips, F.col("id"), F.col("c")), "id") == [("x",)]


def test_queue_filters(spark):
    q = spark.createDataFrame([(1, "1", "r1", "k"), (2, "2", "r1", "k"), (3, "2", "r2", "k")], "row_pos int, pipeline string, reporter string, channel string")
    assert rows(queue.select_rows(q, reporters=["r2"]), "row_pos") == [(1,), (3,)]
    assert rows(queue.select_rows(q, exclude=["r2"], limit=1), "row_pos") == [(1,)]
    s = queue.validate_segments(spark.createDataFrame([("1", ""), ("a", "2"), ("5", "4"), ("", ""), ("1:00", "2:00")], "a string, b string"), "a", "b")
    assert [r[0] for r in s.select("reason").collect()] == ["one_bound_missing", "unparseable", "end_not_after_start", None, None]


def test_stable_partition_and_budget(spark):
    q = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "row_pos int, b int")
    assert rows(queue.stable_partition(q, F.col("b")), "new_pos", "row_pos") == [(1, 2), (2, 4), (3, 1), (4, 3)]
    h = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 2.0), ("a", 3, 2.0)], "k string, p int, h double")
    assert rows(queue.budget_stop(h, ["k"], "p", "h", 3.0), "p") == [(1,), (2,)]


def test_journal(spark):
    r = spark.createDataFrame([("a",), ("b",), ("c",)], "clip string")
    j = spark.createDataFrame([("a", ["x"], 0), ("a", ["y", "z"], 1), ("b", [], 0)], "old string, new array<string>, ordinal int")
    assert rows(queue.replay_journal(r, j, "clip")) == [("c",), ("y",), ("z",)]


def test_reasons(spark):
    df = spark.createDataFrame([(0, 3), (1, 3), (1, 20)], "track_ok int, n_frames int")
    rules = [("track_gap", F.col("track_ok") != 1), ("too_few_frames", F.col("n_frames") < 9)]
    assert [r[0] for r in df.select(quality.first_reason(rules)).collect()] == ["track_gap", "too_few_frames", None]
    assert rows(quality.standalone_counts(df, rules)) == [("too_few_frames", 2, 1), ("track_gap", 1, 1)]


def test_assertions(spark):
    good = spark.createDataFrame([("s1", "k1", "train"), ("s2", "k2", "test")], "speaker_id string, channel string, split string")
    quality.assert_split_sound(good)
    with pytest.raises(quality.QualityError):
        quality.assert_split_sound(good.union(spark.createDataFrame([("s3", "k2", "train")], good.schema)))
    with pytest.raises(quality.QualityError):
        quality.assert_split_sound(good.union(spark.createDataFrame([("s1", None, "val")], good.schema)))
    with pytest.raises(quality.QualityError):
        quality.assert_known(["s9"], good, "speaker_id")


def test_kappa(spark):
    pairs = [("c", "c")] * 4 + [("c", "w"), ("w", "c")] + [("w", "w")] * 2
    df = spark.createDataFrame([("word", *p) for p in pairs], "kind string, va string, vb string")
    assert rows(agreement.cohen_kappa(df, ["kind"])) == [("word", 8, 0.75, 0.466667)]
    same = spark.createDataFrame([("word", "c", "c")] * 3, "kind string, va string, vb string")
    assert rows(agreement.cohen_kappa(same, ["kind"]), "kappa") == [(None,)]


def test_histogram(spark):
    df = spark.createDataFrame([("t", v) for v in (-1.0, 0.0, 0.05, 1.0, 2.0, None)], "s string, v double")
    got = {r["lo"]: r["n"] for r in stats.histogram(df, F.col("v"), "s", stats.edges(0, 1, 0.05)).collect()}
    assert got[0.0] == 2 and got[0.05] == 1 and got[0.95] == 2 and sum(got.values()) == 5 and len(got) == 20


def test_train_cap(spark):
    data = [(f"c{i}", "big" if i < 40 else f"s{i}", f"l{i % 4}", "train") for i in range(100)]
    df = spark.createDataFrame(data, "clip_id string, spk string, lab string, split string")
    out = sampling.train_cap(df, "spk", "lab", "split", "clip_id", 0.15, 1)
    left = out.where("NOT capped AND spk = 'big'").groupBy("lab").count().collect()
    assert {r["count"] for r in left} == {4} and out.where("capped AND spk <> 'big'").count() == 0


def test_negatives(spark):
    pos = spark.createDataFrame([("a", "test", f"c{i}") for i in range(5)], "class string, split string, clip_id string")
    pool = spark.createDataFrame([("test", f"c{i}") for i in range(8)], "split string, clip_id string")
    got = rows(sampling.negatives(pos, pool, ["class", "split"], "clip_id", 100, 1), "clip_id")
    assert got == [("c5",), ("c6",), ("c7",)]
    assert sampling.negatives(pos, pool, ["class", "split"], "clip_id", 2, 1).count() == 2


def test_ranked_matches_window(spark):
    data = [("hot" if i % 3 else f"k{i % 7}", (i * 37) % 101, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v int, i int").repartition(7)
    got = {(r["i"]): r["r"] for r in hotkeys.ranked(df, ["k"], [F.col("v").desc(), F.col("i").asc()], "r").collect()}
    by = {}
    for k, v, i in sorted(data, key=lambda x: (x[0], -x[1], x[2])):
        by[i] = by.get(("n", k), 0) + 1
        by[("n", k)] = by[i]
    assert got == {i: by[i] for _, _, i in data}


def test_per_key_stitches_runs_over_partitions(spark):
    data = [(None if i % 11 == 0 else ("hot" if i % 3 else f"k{i % 5}"), f"id{(i * 7) % 400}" if i % 13 else None, i, 1.0, 0.5 if i % 2 else None) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, id string, at int, h double, c double")
    for parts in (1, 9):
        got = {r["key"]: (r["rows"], r["clips"], r["hours"], r["mean_confidence"]) for r in hotkeys.per_key(df, F.col("k"), F.col("id"), F.col("at"), F.col("h"), F.col("c"), parts).collect()}
        want = {}
        for key in {d[0] for d in data}:
            mine = [d for d in data if d[0] == key]
            last = {}
            for d in sorted(mine, key=lambda d: d[2]):
                if d[1] is not None:
                    last[d[1]] = d
            conf = [d[4] for d in last.values() if d[4] is not None]
            want[key] = (len(mine), len(last), float(len(last)), round(sum(conf) / len(conf), 4) if conf else None)
        assert got == want


def test_p7_edges(spark):
    empty = spark.createDataFrame([], "k string, id string, at int, h double, c double")
    assert hotkeys.per_key(empty, F.col("k"), F.col("id"), F.col("at"), F.col("h"), F.col("c")).count() == 0
    clash = spark.createDataFrame([("a", "x", 1, 1.0, 0.5, 9, 9, 9)], "k string, id string, at int, h double, c double, rows int, key int, part int")
    assert rows(hotkeys.per_key(clash, F.col("k"), F.col("id"), F.col("at"), F.col("h"), F.col("c"))) == [("a", 1, 1, 1.0, 0.5)]
    assert rows(hotkeys.dominant(hotkeys.per_key(clash, F.col("k"), F.col("id"), F.col("at"), F.col("h"), F.col("c")), "t")) == [("t", "a")]


def test_components(spark):
    e = spark.createDataFrame([("a", "X"), ("b", "X"), ("b", "Y"), ("c", "Z"), ("d", None)], "l string, r string")
    assert rows(bipartite_components(e, "l", "r")) == [("a", "a"), ("b", "a"), ("c", "c")]
    chain = spark.createDataFrame([(f"n{i:03d}", f"e{j:03d}") for i in range(60) for j in (i, i + 1)], "l string, r string")
    assert {r["unit"] for r in bipartite_components(chain, "l", "r").collect()} == {"n000"}


def test_split_search(spark):
    u = spark.createDataFrame([("a", 10), ("b", 10), ("c", 5), ("d", 75)], "unit string, n int")
    combos = splitsearch.unit_combos(u, 3, 0.06, 0.2)
    assert rows(combos.select(F.array_join("combo", ""))) == [("a",), ("ab",), ("ac",), ("b",), ("bc",)]
    pairs = splitsearch.combo_pairs(combos)
    assert pairs.count() == 8 - 2 and pairs.where("score = 0").count() == 2
    uc = spark.createDataFrame([("a", "x", 1), ("d", "x", 4), ("b", "y", 5), ("d", "y", 1)], "unit string, class string, n int")
    left = splitsearch.classes_left(pairs, uc, 2)
    assert rows(left.where("array_join(test, '') = 'b' AND array_join(val, '') = 'a'"), "classes") == [(1,)]
    assert splitsearch.rank_of(left, F.array_join("test", "") == "zz").first()[0] == -1
    assert splitsearch.top_candidates(left, F.array_join("test", "") == "b", 2).count() >= 2


def test_sync(spark):
    v = spark.createDataFrame([("c", i, [float(i % 7), float(i)]) for i in range(40)], "c string, i int, v array<double>")
    a = v.select("c", (F.col("i") + 2).alias("i"), "v").where("i < 40")
    d = sync.offset_distances(v, a, ["c"], "i", "v", 3, 0.0)
    assert d.count() == 280
    best = sync.best_offset(d.where("i BETWEEN 4 AND 36"), ["c"], 30).first()
    assert best["offset"] == -2 and best["min_dist"] == 0.0 and best["confidence"] > 0
    s = sync.threshold_sweep(spark.createDataFrame([(3.0, True), (1.0, False)], "s double, p boolean"), F.col("s"), F.col("p"))
    assert sync.best_threshold(s).first()[0] == 1.5


def test_vocabulary(spark):
    t = spark.createDataFrame([("ev", 10, 3), ("2021", 10, 3), ("bir", 10, 3), ("az", 1, 3)], "class string, train_n int, n_speakers int")
    stop = spark.createDataFrame([("bir",)], "word string")
    assert rows(vocab.choose_vocabulary(t, 5, 2, True, stop), "class") == [("ev",)]
    assert rows(vocab.vocabulary_removals(t, 5, 2, stop)) == [("digit", 1), ("kept", 1), ("min_train", 1), ("stoplist", 1)]


FIELDS = {"clip_id": "string", "fps": "string", "surface_form": "string"}


def test_tolerant_manifest(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("clip_id,fps,surface_form\na,25,NA\nb,25,\"x, y\"\n,25,z\nc,,z\n".encode() + b"\0\0\0")
    good, bad = manifests.read_manifest(spark, str(p), FIELDS)
    assert rows(good, "clip_id", "surface_form") == [("a", "NA"), ("b", "x, y")] and bad.first()[0] == 3
    q = tmp_path / "b.csv"
    q.write_bytes(b"clip_id,fps,surface_form\na,25,null\nb,25,cu")
    good, bad = manifests.read_manifest(spark, str(q), FIELDS)
    assert rows(good, "clip_id", "surface_form") == [("a", "null")] and bad.first()[0] == 1
    with pytest.raises(ValueError):
        manifests.read_manifest(spark, str(q), {**FIELDS, "nope": "string"})


def test_csv(spark, tmp_path):
    p = tmp_path / "links.csv"
    p.write_text("﻿clip_id,fps,surface_form\na,,NA\n", encoding="utf-8")
    assert rows(manifests.read_csv(spark, str(p), FIELDS), "clip_id", "fps", "surface_form") == [("a", "", "NA")]
    assert manifests.read_csv(spark, str(tmp_path / "none.csv"), FIELDS).count() == 0
    with pytest.raises(FileNotFoundError):
        manifests.read_csv(spark, str(tmp_path / "none.csv"), FIELDS, missing_ok=False)
    d = tmp_path / "classes.csv"
    d.write_text("﻿lemma,rank,count,speakers\nve,1,9,3\n", encoding="utf-8")
    assert rows(manifests.class_distribution(spark, str(d), "lemma")) == [("ve", 1, 9, 3)]


def test_typed_view(spark):
    df = spark.createDataFrame([("a", "", "nan"), ("b", "3", "x")], "k string, n string, d string")
    assert rows(df.select(*schemas.typed({"k": "string", "n": "int", "d": "double"}))) == [("a", None, None), ("b", 3, None)]


def test_exports(spark, tmp_path):
    def answer(who, verdict, cancelled=False, fix=None):
        r = [{"from_name": "verdict", "value": {"choices": [verdict]}}] if verdict else []
        return {"completed_by": who, "was_cancelled": cancelled, "result": r + ([{"from_name": "label_fix", "value": {"text": [fix]}}] if fix else [])}

    task = {"data": {"kind": "word", "clip_id": "c1", "split": "val"}, "annotations": [answer({"email": "a@x"}, "correct"), answer(7, "wrong_word", fix=" ev "), answer(8, "correct", True), answer(9, None)]}
    for name in ("t1", "t2"):
        (tmp_path / f"{name}.json").write_text(json.dumps([task]))
    got = agreement.flatten_exports(manifests.read_exports(spark, str(tmp_path)))
    assert rows(got, "annotator", "verdict", "label_fix") == [("t1:7", "wrong_word", "ev"), ("t1:a@x", "correct", ""), ("t2:7", "wrong_word", "ev"), ("t2:a@x", "correct", "")]
    (tmp_path / "bad.json").write_text(json.dumps([{"data": {"kind": "word"}}]))
    with pytest.raises(ValueError):
        manifests.read_exports(spark, str(tmp_path))


def test_lists_logs_and_files(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("İL # x\n\n# all\nve\nve\n", encoding="utf-8")
    assert rows(manifests.read_words_list(spark, str(tmp_path / "stop.txt"))) == [("il",), ("ve",)]
    (tmp_path / "links.txt").write_text("# no\nu1 # kept\n\n")
    assert rows(manifests.read_links(spark, str(tmp_path / "links.txt"))) == [("u1 # kept",)]
    (tmp_path / "run.log").write_text("[phase2] 1/9\nother\n[phase2] FAILED x\n[phase2] 3/9\n")
    assert rows(manifests.log_progress(manifests.read_log(spark, str(tmp_path / "run.log")))) == [(3, 9, 1)]
    (tmp_path / "cache.json").write_text('{"a": 720, "b": 1080}')
    assert rows(manifests.read_map(spark, str(tmp_path / "cache.json"))) == [("a", 720), ("b", 1080)]
    (tmp_path / "m").mkdir()
    np.savez(tmp_path / "m/x.npz", frames=np.full((2, 2), 3, np.uint8))
    (tmp_path / "m/y.npz").write_bytes(b"broken")
    st = release.pixel_statistics(spark, str(tmp_path / "m")).first()
    assert (st["files"], st["unreadable"], st["mean"], st["std"]) == (2, 1, 3.0, 0.0)
    assert manifests.read_tensors(spark, str(tmp_path / "m")).select("shape").first()[0] == [2, 2]
    listing = manifests.read_listing(spark, str(tmp_path / "m"))
    assert listing.count() == 2 and release.banned_files(listing).count() == 2
    with pytest.raises(quality.QualityError):
        release.assert_no_media(listing)


def test_snapshots_and_export(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.commit_snapshot(spark.range(3), root)
    sinks.commit_snapshot(spark.range(5), root)
    assert sinks.read_snapshot(spark, root).count() == 5 and sinks.read_snapshot(spark, str(tmp_path / "no")) is None
    sinks.export_csv(spark.createDataFrame([("b", "x, y"), ("a", "")], "k string, v string"), str(tmp_path / "o.csv"), ["k"])
    assert (tmp_path / "o.csv").read_text() == 'k,v\na,\nb,"x, y"\n'
    q = spark.createDataFrame([("a", ""), ("b", "")], "id string, completed string")
    sinks.record_completions(q.where("id = 'a'"), "id", str(tmp_path / "log"), "2026-01-01")
    assert rows(sinks.with_completions(q, spark.read.parquet(str(tmp_path / "log")), "id"), "id", "completed") == [("a", "1"), ("b", "")]


def test_stream_resumes_without_duplicates(spark, tmp_path):
    src, root, cp = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "cp")
    part = lambda ids: spark.createDataFrame([(i, f"s{i}") for i in ids], "id int, source string").coalesce(1).write.mode("append").parquet(src)
    make = lambda b: {"rows": b, "marker": b.select("source").distinct()}
    part([1, 2])
    schema = spark.read.parquet(src).schema
    run = lambda: incremental.run_available(incremental.stream_manifest(spark, src, schema), make, root, "marker", cp)
    run()
    part([3])
    run()
    run()
    assert rows(sinks.read_committed(spark, root, "rows", "marker", "source"), "id") == [(1,), (2,), (3,)]
    # Rows whose marker is missing are skipped.
    spark.createDataFrame([(9, "s9")], "id int, source string").write.parquet(f"{root}/rows/batch=99")
    assert sinks.read_committed(spark, root, "rows", "marker", "source").count() == 3


def test_shared_folder(tmp_path):
    from types import SimpleNamespace

    from clipwright.session import checkpoint_root

    def session(value):
        conf = SimpleNamespace(get=lambda k, d=None: value)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(applicationId=f"app-{tmp_path}", getConf=lambda: conf))

    assert checkpoint_root(session("file:///shared/")) == "file:///shared"
    own = checkpoint_root(session(None))
    assert own == checkpoint_root(session(None)) and "clipwright-" in own
