"""Every registered query against its SQL on the smallest tables; the others must give rows."""

import pytest
from conftest import SMALL
from oracle import connect, differences

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Model fits and searches are many small jobs; these run in the tool over all queries, and their operators in tests of their own.
SLOW = {"best_of_two_searches", "kernel_svm", "label_version_comparison", "cross_validation", "grid_search", "elbow", "fuzzy_select"}
SLOW |= {"hierarchy_sweep", "stability_rounds", "elbow_range", "fold_search_degrees"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5
