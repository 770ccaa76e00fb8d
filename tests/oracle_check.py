"""Compare registered queries with their SQL, run by DuckDB on the same files."""

from __future__ import annotations

import math
import os

import duckdb

from docsync.plans.inputs import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{files}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    return str(value)


def table_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[list[str], list, list[str], list]:
    df = query(spark, sf_dir)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = table_of(names, cur.fetchall())
    return sorted(df.columns), got, sorted(names), want
