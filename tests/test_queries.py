"""Every registered query against its SQL, in a session with a foreign time zone."""

import pytest

import __spark_entry__ as entry
from calltide.plans import registry
from tests.compare import connect, difference

NAMES = list(registry.QUERIES)  # optional queries have tests of their own


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) is None


def test_entry_has_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["ds", "complaint_type", "borough", "agency", "y", "y_lag7", "y_ma7"]
    assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
