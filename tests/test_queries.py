"""Every registered query beside its SQL, on the smallest data."""

import os

import pytest

import __spark_entry__ as entry
import registry
from registry.tables import TABLES
from tools.check import digest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    found = db.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, rows)[0] == digest(names, found.fetchall())[0]


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
