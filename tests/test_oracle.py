"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as registry
from check import compare, connect
from tarmac.plans import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_runs_and_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_entry_has_rows_and_names(spark):
    df = registry.entry(spark)
    assert df.count() > 0
    assert "capped_delay" in df.columns


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
