"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from oracle_compare import connect, duckdb_result, first_differences, spark_result
from stratalake.workload.oracle import ORACLE_SQL as ORACLE
from stratalake.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 12


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    columns, rows = spark_result(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duckdb_result(con, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected, first_differences(rows, expected)
