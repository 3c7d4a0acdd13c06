"""Every registered query against its SQL: names, types, and all values."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from workload import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, db, name):
    assert differences(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name]) == []
