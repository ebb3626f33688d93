"""Every query against its SQL, on whole tables."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as driver
from millrace.plans import oracles as library_oracles
from millrace.plans import queries as library

QUERIES = driver.queries()
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(library.QUERIES) == set(library_oracles.ORACLES)


@pytest.mark.parametrize("name", list(library.QUERIES))
def test_same_rows(spark, sf_dir, con, name):
    columns, found = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert len(found) == len(expected)
    assert found == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
