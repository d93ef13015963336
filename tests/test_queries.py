"""Every registered query of the library against its SQL, row by row."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from testbed.compare import connect, duckdb_rows, spark_rows
from testbed.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(queries()) & set(QUERIES) == set(oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, db, name):
    columns, rows = spark_rows(queries()[name](spark, sf_dir))
    expected_columns, expected = duckdb_rows(db, oracle_sql()[name])
    assert columns == expected_columns
    assert rows, "an empty result checks nothing"
    assert rows == expected


def test_entry(spark):
    assert entry(spark).count() > 0
