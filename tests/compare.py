"""Holds a query's rows against its SQL in DuckDB."""

from pathlib import Path

import duckdb

DATA = "/root/testdata/sf0.001"


def connection(folder: str = DATA):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def same(spark, query, sql, folder: str = DATA):
    df = query(spark, folder)
    cols = sorted(df.columns)
    got = _sorted(tuple(r[c] for c in cols) for r in df.collect())
    rel = connection(folder).sql(sql)
    names = [c.strip('"') for c in rel.columns]
    assert sorted(names) == cols
    want = _sorted(tuple(r[names.index(c)] for c in cols) for r in rel.fetchall())
    assert got == want
