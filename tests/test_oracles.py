"""Every registered query with an oracle gives the same rows as its SQL."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    _, problems = compare(spark, connection, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert not problems


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = {r["metric"]: r for r in entry.entry(spark).collect()}
    assert set(rows) == {"Rows", "Missing values", "Duplicates", "Outliers (IQR)"}
    assert rows["Duplicates"]["after"] == 0
