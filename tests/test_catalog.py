"""Every registered query against its SQL, on the smallest data."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from daymetrics.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) == ""


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) & set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
