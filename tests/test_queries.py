"""Every query against its SQL text at the smallest scale; one without SQL is named here and has its own test."""

import duckdb
import pytest

from workload.catalog import QUERIES
from workload.check import compare
from workload.views import TABLES

FOLDER = "/root/testdata/sf0.001"
#: The whole review run: its stages have SQL each; of the run itself test_review.py tests three cases, and here only rows are counted.
WITHOUT_SQL = {"R8_review_run"}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_names_are_unique():
    names = [q.name for q in QUERIES]
    assert len(names) == len(set(names))


@pytest.mark.parametrize("query", QUERIES, ids=lambda q: q.name)
def test_query(spark, engine, query):
    result = compare(spark, engine, query, FOLDER)
    assert result.startswith("rows" if query.name in WITHOUT_SQL else "ok"), result
