"""Spark result against DuckDB result, order-insensitive, columns matched by name."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(table, key=lambda r: tuple((v is None, type(v).__name__, str(v)) for v in r))


def spark_rows(df):
    return _rows(df.columns, df.collect())


def duck_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return _rows(names, cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    names, mine = spark_rows(df)
    other_names, other = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(mine) != len(other):
        return f"{len(mine)} rows != {len(other)} rows; {mine[:2]} / {other[:2]}"
    for a, b in zip(mine, other):
        if a != b:
            return f"first difference in {names}: {a} != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types differ in {names}: {a} / {b}"
    return None
