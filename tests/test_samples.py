"""The sample queries against their SQL, and the shape of their plans."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from cedeflow.samples.checks import ORACLE_SQL
from cedeflow.samples.queries import QUERIES
from helpers import plan_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("lineitem", "orders", "part", "customer")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _value(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, str):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return repr(float(value))


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sql, name):
    report = QUERIES[name](spark, SF_DIR)
    plan = plan_of(report)
    for slow in ("NestedLoop", "Cartesian", "Python", "ExistingRDD"):
        assert slow not in plan
    found = sql.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(report.columns)
    assert len(set(columns)) == len(columns)
    expected = found.fetchall()
    assert expected
    assert _rows(report.columns, report.collect()) == _rows(columns, expected)


def test_entry(spark):
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
