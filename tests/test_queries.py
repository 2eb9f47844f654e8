"""Every registered query against its SQL equivalent in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from adloom.plans.registered import load_all

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def ordered(columns, rows):
    positions = [columns.index(c) for c in sorted(columns)]
    return sorted(repr([row[i] for i in positions]) for row in rows)


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query(spark, database, name):
    frame = entry.queries()[name](spark, str(DATA))
    rows = [tuple(r) for r in frame.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    answer = database.execute(sql)
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert ordered(frame.columns, rows) == ordered(columns, answer.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
