"""The driver's contract on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"create view {f[:-8]} as select * from '{FOLDER}/{f}'")
    df = entry.queries()[name](spark, FOLDER)
    want = con.sql(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    place = [want.columns.index(c) for c in cols]
    got = sorted(tuple(map(repr, (r[c] for c in cols))) for r in df.collect())
    assert got == sorted(tuple(repr(r[i]) for i in place) for r in want.fetchall())


def test_names_pair_up():
    assert set(entry.oracle_sql()) <= set(entry.queries())
