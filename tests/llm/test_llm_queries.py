"""The registered training-data queries against their SQL, and the shapes the contract fixes."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from labelscope.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
ROWS = {"op9_topk": None, "op8_hosts": "pages", "op10_quotes": "conversations"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    found, wanted = QUERIES[name](spark, FOLDER), duck.sql(ORACLES[name])
    assert {c: TYPES.get(t, t) for c, t in found.dtypes} == dict(zip(wanted.columns, map(str, wanted.types)))
    assert sorted(map(repr, map(tuple, found.select(*wanted.columns).collect()))) == sorted(map(repr, wanted.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_a_row_per_input_row(spark, name):
    rows = ROWS.get(name, "documents")
    assert QUERIES[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{rows}.parquet").count()


def test_registered():
    assert set(QUERIES) < set(entry_points.queries()) and "pipeline" in entry_points.queries()
