"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sf, duck, name):
    got, want = entry.queries()[name](spark, sf).toArrow(), duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    rows = lambda t: sorted(map(repr, zip(*[t[c].to_pylist() for c in columns])))
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 2 and os.path.isdir("/root/testdata")
