"""Every registered query against its SQL counterpart in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from fleetspark.catalog.oracle import ORACLE
from fleetspark.catalog.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry_point.queries().items() and ORACLE.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    place = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in place) for r in cursor.fetchall()), key=repr)
    assert got and got == want
