"""Every query with a SQL twin gives the same rows as DuckDB, at the scale of the correctness check."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert compare(df.columns, [tuple(r) for r in df.collect()], con, entry.oracle_sql()[name]) is None


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["item_id", "user_id", "score", "run_date"]
    assert rows.count() > 5
