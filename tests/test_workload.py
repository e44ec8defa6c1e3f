"""The registered queries against their SQL on the smallest tables."""

import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from vereda.plans import workload

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are missing")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, database, name):
    result = entry.queries()[name](spark, FOLDER)
    ours = [tuple(row) for row in result.collect()]
    cursor = database.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert normal(result.columns, ours) == normal(names, cursor.fetchall())


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(workload.QUERIES) - set(entry.oracle_sql()) == {"isolation_forest_events"}
    assert set(workload.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_long_series_forest(spark):
    rows = entry.queries()["isolation_forest_events"](spark, FOLDER)
    counts = rows.groupBy("serie_nome").agg({"anomalia": "count"}).collect()
    assert len(counts) == 5
