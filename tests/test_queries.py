"""Every registered query against its DuckDB counterpart."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_counterpart_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    rows = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(rows.columns) == sorted(columns)
    expected = sorted(result.fetchall(), key=repr)
    assert sorted(map(tuple, rows.select(*columns).collect()), key=repr) == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["url", "date", "content_type", "text"]


def test_progress_events(spark):
    rows = entry.queries()["progress_events"](spark, SF_DIR).orderBy("batch").collect()
    assert {r["batch"] for r in rows} == {0, 1, 2, 3}
    merged = [r for r in rows if r["stage"] == "batch_merged"]
    assert sum(r["matched"] for r in merged) == 1000
    assert all(r["pending"] == 0 and 0 < r["imported"] <= r["matched"] for r in merged)
