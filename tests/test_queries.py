"""Each registered query against its SQL, over whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as registered

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def rows(table, columns):
    def plain(value):
        return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value

    return sorted(repr([plain(r[name]) for name in columns]) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    got = registered.queries()[name](spark, SF_DIR).toArrow()
    want = database.sql(registered.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    assert got.num_rows > 0
    assert rows(got, columns) == rows(want, columns)


def test_entry(spark):
    assert registered.entry(spark).count() == 16  # with the blank one
