"""Comparison of a query with its SQL in DuckDB, as the driver does it."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for file in Path(directory).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def canonical(value: object) -> object:
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.9g}"
    return str(value)


def same(spark, con, directory: str, query, sql: str) -> None:
    df = query(spark, directory)
    columns = sorted(df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted((tuple(canonical(r[i]) for i in places) for r in result.fetchall()), key=str)
    got = sorted((tuple(canonical(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got == expected
