"""The queries that have SQL twins against them."""

import oracle
import pytest

from listmill.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    rows, problem = oracle.compare(spark, oracle.connect(FOLDER), FOLDER, queries.QUERIES[name], queries.ORACLES[name])
    assert problem is None and rows > 0
