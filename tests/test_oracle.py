"""Every query with an SQL twin gives the same rows on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import compare, database
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, con, name):
    assert compare(spark, con, name, queries()[name], oracle_sql()[name], SF) is None


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())
