"""Every named query runs, and equals its SQL twin where there is one."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    rows, problem = compare(spark, con, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "y_lag_1" in df.columns
