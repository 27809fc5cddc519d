"""Every registered query against DuckDB at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert differences(result, duck, ORACLES[name]) is None
    else:
        assert result.columns and result.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert ORACLES.keys() <= QUERIES.keys()
