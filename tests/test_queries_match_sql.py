"""Every query with an SQL counterpart gives the same rows in both engines."""

from __future__ import annotations

import importlib
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tools.compare import TABLES, canonical

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
CHECKS = {
    name: check
    for module in entry_point.MODULES
    for name, check in importlib.import_module(f"checks.{module}").checks.items()
}
QUERIES = {name: check.query for name, check in CHECKS.items()}
SQL = {name: check.sql for name, check in CHECKS.items() if check.sql is not None}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in frame.collect()]
    result = duck.execute(SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    order = sorted(names)
    assert canonical(rows, frame.columns, order) == canonical(result.fetchall(), names, order)


@pytest.mark.parametrize("name", ["src4_file_formats", "src5_file_fingerprints", "met13_artifact_size", "ml4_logistic_regression"])
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.count() == 6
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.queries())


def test_names():
    for name in QUERIES:
        assert "pipeline" not in name
        assert not (name.startswith("op") and name[2:3].isdigit())
