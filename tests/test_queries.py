"""Every registered query against its SQL twin on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry
from listmill.bindings.registry import ORACLES as SQL
from listmill.bindings.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, problem = oracle.compare(spark, con, FOLDER, QUERIES[name], SQL.get(name))
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
