"""Every registered query against its SQL, on the smallest given tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return str(value) if isinstance(value, decimal.Decimal) else value


def ordered(columns, rows):
    return sorted(([plain(r[c]) for c in columns] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = [r.asDict() for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    assert sorted(names) == sorted(df.columns)
    assert ordered(sorted(names), got) == ordered(sorted(names), expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
