"""What the plans must look like: pruned scans, pushed filters, no Python rows, no window over a whole table."""

import re

import pytest

from clipwright.operators import hotkeys
from clipwright.plans import registry
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return {c.split(":")[0] for m in re.findall(r"ReadSchema: struct<([^>]*)>", text) for c in m.split(",") if c}


def test_scans_read_only_what_they_need(spark):
    p = plan(registry.vocab_surface(spark, SF))
    assert read_columns(p) <= {"speaker_id", "channel", "split", "surface_form"}
    p = plan(registry.stratified_sample(spark, SF))
    assert "IsNotNull(clip_id)" in p and "npz_path" not in p
    assert read_columns(plan(registry.height_quantiles(spark, SF))) == {"split", "face_height_px"}


@pytest.mark.parametrize("name", ["token_classes", "vocab_lemma", "quality_rules", "train_cap", "spotting_queries", "track_islands", "kappa", "release_words", "suffix_join", "word_gates", "greedy_overlap"])
def test_no_python_and_no_products(spark, name):
    p = plan(registry.queries()[name](spark, SF))
    assert "Python" not in p and "MapInPandas" not in p and "CartesianProduct" not in p


def test_aggregates_shrink_before_the_shuffle(spark):
    p = plan(registry.pair_counts(spark, SF))
    assert p.count("HashAggregate") == 2 and p.count("Exchange") == 1


def test_hot_keys_are_range_partitioned(spark):
    p = plan(hotkeys.speaker_results(spark, SF))
    assert "rangepartitioning" in p and "npz_path" not in p and "surface_form" not in p
