"""Intermediate tables, and components of a graph in both of its ways."""

import os
import random
from types import SimpleNamespace

import pytest

from clipwright import session
from clipwright.operators.graph import bipartite_components
from tests.conftest import rows


def test_no_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://somewhere:7077", applicationId="none"))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(spark)


def test_release_and_sweep(spark):
    a, b = session.cut(spark.range(3)), session.cut(spark.range(4))
    path, other = a._cut_path, b._cut_path
    assert os.path.isdir(path) and a.count() == 3
    session.release(a)
    assert not os.path.isdir(path) and path not in session._CUTS
    session.sweep(spark)
    assert not os.path.isdir(other)


def components(edges):
    unit = {}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for l, r in edges:
        if l is not None and r is not None:
            parent[find(("r", r))] = find(("l", l))
    for l, r in edges:
        if l is not None and r is not None:
            unit.setdefault(find(("l", l)), set()).add(l)
    return {(l, min(g)) for g in unit.values() for l in g}


@pytest.mark.parametrize("limit", [0, 1000])
def test_components_with_a_hot_node_and_chains(spark, limit):
    r = random.Random(3)
    edges = [(f"s{r.randrange(300)}", f"c{r.randrange(200)}") for _ in range(200)]
    edges += [(f"h{i}", "hot") for i in range(150)] + [(f"k{i:03}", f"e{j}") for i in range(40) for j in (i, i + 1)]
    edges += [(None, "hot"), ("lonely", None), ("h1", "hot"), ("h1", "hot")]
    df = spark.createDataFrame(edges, "a string, b string")
    assert set(rows(bipartite_components(df, "a", "b", max_broadcast=limit))) == components(edges)
    assert rows(bipartite_components(df.limit(0), "a", "b", max_broadcast=limit)) == []
