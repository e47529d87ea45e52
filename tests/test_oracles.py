"""Every registered query against its SQL, over whole tables."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("customer", "orders", "lineitem")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _multiset(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    rows = expected.fetchall()
    assert rows, "the check would be empty"
    assert _multiset(result.columns, result.collect()) == _multiset(names, rows)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    result = entry(spark)
    assert result.count() == 150
    assert {"id", "dob", "age", "canDrive"} <= set(result.columns)
