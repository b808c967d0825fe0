"""Every query of the subpackage that SQL can express, against its SQL at the smallest scale."""

import duckdb
import pytest

from paperloom.llm.queries import ORACLE_SQL, QUERIES
from workload.check import compare
from workload.query import Query
from workload.views import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for t in {*TABLES, "documents"}:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, engine, name):
    result = compare(spark, engine, Query(name, QUERIES[name], ORACLE_SQL[name]), FOLDER)
    assert result.startswith("ok"), result
