"""Every registered query, against its oracle at the smallest scale."""

from __future__ import annotations

import pytest
from compare import compare, oracle_connection
from conftest import FOLDER

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_connection(FOLDER)
    yield connection
    connection.close()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, FOLDER).count() > 0
        return
    problem = compare(spark, oracle, FOLDER, name, QUERIES[name], ORACLES[name])
    assert problem is None or problem == "no rows on either side"
