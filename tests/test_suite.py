"""Every registered query against DuckDB on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as e
from oracle import differences, tables
from recspark.plans.suite import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return tables(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    assert name in e.oracle_sql()
    assert not differences(e.queries()[name](spark, SF), con, e.oracle_sql()[name])


def test_entry(spark):
    assert e.entry(spark).columns == ["batch", "count", "total", "mean", "std"]
