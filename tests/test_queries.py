"""Every named query against its DuckDB statement."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from oracles.compare import connect, differences

SMALL = entry_points.SMOKE_DIR
STATEMENTS = entry_points.STATEMENTS
QUERIES = {name: query for name, query in entry_points.queries().items() if name in entry_points.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, STATEMENTS[name]) == []
