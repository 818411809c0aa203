"""Every registered query with a SQL counterpart gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import difference, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.slow
@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, con, key):
    assert difference(spark, con, SMALL, key) is None


def test_entry_has_rows(spark):
    assert not entry_points.entry(spark).isEmpty()


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
