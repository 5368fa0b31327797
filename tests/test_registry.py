"""Registered batch queries against their SQL on the smallest tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as contract
from tidemark.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
# Estimates have no SQL; test_streaming holds them against the exact numbers.
BATCH = sorted(name for name in QUERIES if not name.endswith("_stream") and name in ORACLES)

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_tables
@pytest.mark.parametrize("name", BATCH)
def test_query_equals_its_sql(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in places) for row in result.fetchall())
    assert Counter(map(tuple, got.select(*columns).collect())) == want


@needs_tables
def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
