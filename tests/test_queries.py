"""Every registered query against its SQL on the given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from docloom.plans.oracles import all_oracles
from docloom.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value:.9g}"
        if isinstance(value, int) and not isinstance(value, bool):
            return f"{float(value):.9g}" if abs(value) < 2**53 else str(value)
        return str(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, duck, name):
    df = all_queries()[name](spark, SF_DIR)
    rows = [tuple(row) for row in df.collect()]
    cursor = duck.execute(all_oracles()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = cursor.fetchall()
    assert len(rows) == len(expected)
    assert canonical(df.columns, rows) == canonical(columns, expected)
    assert len(rows) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
