"""All pN queries: empty tables, null rows, extra columns with clashing names, and their SQL."""

import pytest

from clipwright.llm import queries as q
from tests.conftest import SF, rows
from tests.llm.helpers import with_extras, write_all
from tests.test_queries import compare

FOUND = ["p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p8_containers", "p9_found", "p10_found"]


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write_all(spark, tmp_path_factory.mktemp("empty"))


@pytest.fixture(scope="module")
def extras(spark, tmp_path_factory):
    return with_extras(spark, tmp_path_factory.mktemp("extras"))


@pytest.fixture(scope="module")
def nulls(spark, tmp_path_factory):
    return with_extras(spark, tmp_path_factory.mktemp("nulls"), dirty=True)


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_empty_tables(spark, empty, name):
    got = q.queries()[name](spark, empty)
    if name in ("p2_ties", "p8_room"):  # one row of figures
        assert [tuple(r) for r in got.collect()] == [{"p2_ties": (0, 0, 0), "p8_room": (0, 0, 0, True)}[name]]
    else:
        assert got.count() == 0


@pytest.mark.parametrize("name", FOUND)
def test_extra_columns_and_null_rows(spark, extras, nulls, name):
    plain = rows(q.queries()[name](spark, SF))
    assert plain
    assert rows(q.queries()[name](spark, extras)) == plain
    dirty = rows(q.queries()[name](spark, nulls))
    if name == "p8_containers":  # the null row is a text of no tokens and packing may move others
        assert len(dirty) == len(plain) + 1
    else:
        assert dirty == plain


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_sql(spark, name):
    compare(spark, q.queries()[name], q.oracle_sql()[name], SF)
