"""Every registered query against its SQL oracle."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

DATA = Path(os.environ.get("SMELTERY_TEST_DATA", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    yield connection
    connection.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, str(DATA))
    cursor = duck.execute(entry_points.oracle_sql()[name])
    want = canonical([c[0] for c in cursor.description], cursor.fetchall())
    assert canonical(df.columns, df.collect()) == want


#: Its result is the time it ran at.
WITHOUT_SQL = {"run_stamp"}


def test_every_query_of_the_tables_has_an_oracle():
    own = set(entry_points._CATALOGUE)
    assert own - set(entry_points.oracle_sql()) == WITHOUT_SQL


def test_run_stamp(spark):
    rows = entry_points.queries()["run_stamp"](spark, str(DATA))
    assert rows.dtypes == [("dt_ingestion", "timestamp"), ("n", "bigint")]
    # All rows of a query have one time.
    assert len(rows.collect()) == 1


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["source", "lang", "quantity"]
    assert df.count() > 0
