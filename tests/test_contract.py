"""Every registered query against its SQL on another engine, over the whole tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from vinlake.contract.oracle import ORACLE_SQL
from vinlake.contract.queries import QUERIES

FOLDER = os.environ.get("CONTRACT_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    ours = QUERIES[name](spark, FOLDER)
    theirs = oracle.execute(ORACLE_SQL[name])
    columns = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = _rows(columns, theirs.fetchall())
    actual = _rows(ours.columns, [tuple(row) for row in ours.collect()])
    assert len(actual) == len(expected) > 0
    for got, want in zip(actual, expected):
        assert got == want
