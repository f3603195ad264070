"""Every registered query against its SQL, on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = entry.SMOKE_DIR
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got or name in ("recent_load_errors", "rls_store_filter")
    if name in entry.oracle_sql():
        found = duck.execute(entry.oracle_sql()[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert got == sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)
