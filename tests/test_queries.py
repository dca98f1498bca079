"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)
# The queries of the llm package have their own tests.
QUERIES = dict(entry_point.QUERIES)
ORACLES = dict(entry_point.ORACLES)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def rows(frame: pd.DataFrame):
    columns = sorted(frame.columns)
    values = frame[columns].itertuples(index=False)
    return sorted(tuple("NULL" if pd.isna(v) else str(v) for v in row) for row in values)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["value"]
    assert frame.count() > 0
