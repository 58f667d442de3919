"""Every registered core query against its SQL on the smallest tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from clipwright.plans import oracle, registry
from tests.conftest import SF


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def compare(spark, query, sql, sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((str(tuple(norm(r[c]) for c in cols)) for r in df.collect()))
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted(str(tuple(norm(r[i]) for i in at)) for r in cur.fetchall())
    assert [g.replace(".0,", ",").replace(".0)", ")") for g in got] == [w.replace(".0,", ",").replace(".0)", ")") for w in want]


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    if name in oracle.SQL:
        compare(spark, registry.queries()[name], oracle.SQL[name], SF)
    else:
        assert registry.queries()[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["class", "train_n", "val_n", "test_n", "n_speakers", "n_channels"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_core_imports_nothing_of_llm():
    for p in glob.glob(os.path.join(os.path.dirname(registry.__file__), "..", "**", "*.py"), recursive=True):
        if f"{os.sep}llm{os.sep}" not in os.path.abspath(p):
            assert "llm" not in open(p).read(), p
