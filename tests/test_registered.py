"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    clean = lambda x: None if isinstance(x, float) and math.isnan(x) else x
    return sorted(repr(tuple(clean(row[k]) for k in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    wanted = duck.sql(ORACLES[name])
    assert {c: TYPES.get(t, t) for c, t in found.dtypes} == dict(zip(wanted.columns, map(str, wanted.types)))
    rows = [tuple(r) for r in found.collect()]
    assert canonical(found.columns, rows) == canonical(wanted.columns, wanted.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert set(entry_points.entry(spark).columns) == {"label", "precision", "recall", "f1", "support"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
