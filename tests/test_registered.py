"""Every registered query against its SQL on the same tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from registered.oracle import ORACLE, SF_DIR
from registered.queries import QUERIES, TABLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    cursor = duck.execute(ORACLE[key])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    at = [names.index(c) for c in order]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
    assert len(ours) == len(theirs)
    assert ours == theirs
    assert ours


def test_flagship(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["path", "source", "target"]
    assert df.count() > 0
