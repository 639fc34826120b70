"""Every named query against its SQL twin."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from samples import TABLES, values

import __spark_entry__ as driver
from spindlewatch.plans.oracle import ORACLE
from spindlewatch.plans.registry import QUERIES


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def bag(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_same_rows_as_sql(spark, tables, database, name):
    found = driver.queries()[name](spark, tables)
    wanted = database.execute(driver.oracle_sql()[name])
    columns = [column[0] for column in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert bag(values(found), found.columns) == bag(wanted.fetchall(), columns)


def test_every_report_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry_is_the_daily_report(spark):
    report = driver.entry(spark)
    assert report.dtypes == [("data", "string"), ("vault_id", "int"), ("failures_count", "bigint")]
    assert report.count() == 70
