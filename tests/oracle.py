"""Compares a query's rows with its DuckDB oracle's, as multisets of rounded values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, int) and not isinstance(v, bool):
        return float(f"{v:.15g}")
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


def rows(columns: list[str], data: list) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(r[k]) for k in order) for r in data)


def assert_same(df, sql: str, con: duckdb.DuckDBPyConnection) -> None:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    a, b = rows(df.columns, df.collect()), rows(names, got.fetchall())
    assert a == b, f"{list((a - b).items())[:3]} against {list((b - a).items())[:3]}"
