"""Holds a query's rows against its SQL in DuckDB, column by column, in any order."""

import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def plain(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)


def same(df, sql, sf_dir):
    names = sorted(df.columns)
    mine = sorted([plain(r[n]) for n in names] for r in df.collect())
    found = connect(sf_dir).execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    theirs = sorted([plain(r[columns.index(n)]) for n in names] for r in found.fetchall())
    assert mine == theirs
