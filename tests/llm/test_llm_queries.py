"""Queries with SQL against DuckDB on the smallest test folder; the rest run."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from docloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = queries.QUERIES[name](spark, FOLDER)
    want = con.sql(queries.ORACLE[name])
    assert sorted(want.columns) == sorted(df.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert Counter(tuple(r) for r in df.collect()) == Counter(tuple(r[i] for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert not name.endswith("_found") or len(rows) == len(set(rows))
