"""Holds a Spark result against DuckDB SQL over the same files."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb

DATA = "/root/testdata"


def views(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        files = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.sql(f"create view {p.stem} as select * from read_parquet('{files}')")
    return con


def _plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v


def rows(columns: list[str], values: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(_plain(v[i])) for i in order) for v in values)


def same(df, sql: str, folder: str) -> None:
    r = views(folder).sql(sql)
    assert sorted(df.columns) == sorted(r.columns)
    assert rows(df.columns, [tuple(x) for x in df.collect()]) == rows(r.columns, r.fetchall())
