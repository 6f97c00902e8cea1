"""Queries against their SQL on the smallest tables, where these are there."""

import os

import duckdb
import pytest

from pagewright.llm.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, df.where(df.notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DIR}/documents.parquet'")
    a, b = QUERIES[name](spark, DIR).toPandas(), con.execute(SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns) and rows(a) == rows(b)
