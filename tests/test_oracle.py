"""Every registered query against its SQL, run by DuckDB over the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from conftest import ROOT, TESTDATA

from ledgerloom.oracle import ORACLE_SQL
from ledgerloom.queries import QUERIES


@pytest.fixture(scope="module")
def oracle(small_dir):
    connection = duckdb.connect()
    for file in Path(small_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_oracle(spark, small_dir, oracle, name):
    df = QUERIES[name](spark, small_dir)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    result = oracle.execute(ORACLE_SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())


def test_entry(spark):
    import __spark_entry__ as driver

    assert str(ROOT) in driver.__file__
    if TESTDATA == "/root/testdata":
        assert driver.entry(spark).count() == 25
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())
