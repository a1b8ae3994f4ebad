"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare, duck

ORACLES = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def con(small_data):
    return duck(small_data)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    own = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}
    assert own <= set(ORACLES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, con, small_data, name):
    result = compare(spark, con, small_data, name, QUERIES[name], ORACLES[name])
    assert result.startswith("ok"), result
    assert "TYPES" not in result


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
