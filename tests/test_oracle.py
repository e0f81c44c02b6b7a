"""Every query with an SQL twin gives what DuckDB gives on the smallest tables; the others run."""

import glob
import os

import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in data)


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, duck, name):
    df, rel = QUERIES[name](spark, sf), duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark, sf):
    assert entry.entry(spark).count() == 10


def test_chunks_of_files(spark, sf):
    got = QUERIES["structure_chunks"](spark, sf).collect()
    assert got and all(r["chunk_text"].strip() for r in got)
