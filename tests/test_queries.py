"""Every registered query against its oracle SQL on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, canonical

SF = "/root/testdata/sf0.001"
# The training-data queries have their own tests.
OWN = [name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_equals_oracle(spark, db, name):
    frame = contract.queries()[name](spark, SF)
    mine = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = db.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert mine == canonical(columns, result.fetchall())
