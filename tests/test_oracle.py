"""Every query that SQL can express gives the rows its SQL gives."""

import os

import compare
import pytest

import __spark_entry__ as driver
from txnrisk.plans import catalog, oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle.oracle_sql()
# A forest cannot be written in SQL.
WITHOUT_SQL = {"train_eval", "score_unlabeled", "review_queue"}


@pytest.mark.parametrize("name", SQL)
def test_same_rows(spark, name):
    result = catalog.queries()[name](spark, FOLDER)
    columns, rows = compare.spark_rows(result)
    expected_columns, expected = compare.sql_rows(SQL[name], FOLDER)
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert [p for p in zip(rows, expected) if p[0] != p[1]][:3] == []


def test_every_query_has_sql_or_a_reason():
    assert set(catalog.queries()) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(catalog.queries()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda r: (-r.alerts, r.payor_country))
