"""Every registered query against DuckDB on the smallest test data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences, duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 24


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    got = spark_rows(queries()[name](spark, SF))
    if name in SQL:
        assert differences(got, duck_rows(con, SQL[name])) == []
    else:
        assert got[1]
