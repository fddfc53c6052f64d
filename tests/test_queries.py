"""Every named query against DuckDB."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, queries
from oracle.queries import expected_sql
from tests.compare import connect, difference
from tests.conftest import SMALL
from tradewinds.queries import QUERIES

EXPECTED = expected_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert difference(queries()[name](spark, SMALL), duck, EXPECTED[name]) is None


def test_every_expected_result_has_a_query():
    assert set(EXPECTED) == set(QUERIES)


def test_entry(spark):
    result = entry(spark)
    assert result.columns[0] == "year_month"
    assert result.count() > 0
