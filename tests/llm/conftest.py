import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "labels", "benchmark"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture
def doc_frame(spark):
    """Documents of (doc_id, text) with columns whose names clash with those the operators add."""

    def make(rows):
        schema = "doc_id bigint, text string, source string, n_shingles string, kept string, size string, row_hash string, n_lines string"
        return spark.createDataFrame([(a, b, "s", "x", "x", "x", "x", "x") for a, b in rows], schema)

    return make
