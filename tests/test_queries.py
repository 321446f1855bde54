"""Every registered query against its SQL twin on the smallest data set."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from quotelake.catalog.oracle import ORACLE
from quotelake.catalog.queries import QUERIES
from tests.conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    try:
        return repr(float(value)) if not isinstance(value, str) else value
    except (TypeError, ValueError):
        return str(value)


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert found and found == canonical(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
