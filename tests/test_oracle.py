"""Every registered query against its SQL on the given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(comparable(row[i]) for i in order) for row in rows]
    return sorted(table, key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, oracle, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    result = oracle.execute(entry_points.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = sorted_rows(columns, result.fetchall())
    actual = sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    assert len(actual) == len(expected)
    for got, wanted in zip(actual, expected, strict=True):
        assert got == wanted
        assert [type(v) for v in got] == [type(v) for v in wanted]
    assert actual, "the query should not be empty"


def test_entry(spark):
    assert entry_points.entry(spark).count() == 4
