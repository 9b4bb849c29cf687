"""Every query of the catalog against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from kerbside import catalog

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    rows = [tuple(row[c] for c in columns) for row in frame.collect()]
    if name not in ORACLES:
        assert rows
        return
    result = database.execute(ORACLES[name])
    names = [item[0] for item in result.description]
    assert sorted(names) == columns
    picks = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in picks) for row in result.fetchall()]
    assert ordered(rows) == ordered(expected)
