"""Every registered query against its SQL on the smallest test tables."""

import os
from decimal import Decimal

import duckdb
from pytest import fixture, mark, skip

import __spark_entry__ as entry_point
from ledgerspan.catalog.all import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        skip("no test tables here")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def shown(value):
    return repr(float(value)) if isinstance(value, (float, Decimal)) else str(value)


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(shown(row[i]) for i in order) for row in rows)


@mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = canonical(frame.collect(), frame.columns)
    if name not in ORACLE:
        assert got
        return
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert got == canonical(result.fetchall(), names)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert QUERIES.keys() <= entry_point.queries().keys() and ORACLE.keys() <= entry_point.oracle_sql().keys()


def test_entry_has_rows(spark):
    assert not entry_point.entry(spark).isEmpty()
