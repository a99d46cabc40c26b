"""Compares a Spark query with its SQL on DuckDB, column by column, order of rows aside."""

import math
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "None"
    return str(v.item() if hasattr(v, "item") else v)


def agree(spark, folder: str, query, sql: str) -> None:
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cur = connect(folder).execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
