"""Every registered query against its DuckDB SQL, on the smallest tables."""

import pytest
from oracle_check import difference, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, connection, name):
    assert difference(entry.queries()[name](spark, SF_DIR), connection, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
