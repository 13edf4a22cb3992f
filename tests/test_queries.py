"""Every registered query against its SQL, on the smallest tables."""

import oracle
import pytest
from conftest import SMALL

from pagetables.plans import catalog
from pagetables.plans.registry import PLANS


@pytest.fixture(scope="module")
def con():
    return oracle.database(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert oracle.difference(spark, con, SMALL, name) is None


def test_every_query_has_sql():
    assert [n for n, p in PLANS.items() if p.oracle is None] == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert catalog.oracle_sql().keys() <= entry.oracle_sql().keys() <= entry.queries().keys()
    frontier = entry.entry(spark)
    assert frontier.columns == ["url", "round", "source", "pos"]
    assert frontier.count() > 0
