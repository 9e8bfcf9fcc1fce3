"""Runs a query and its SQL twin and compares them value by value."""

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _text(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, datetime.datetime):
        return f"datetime:{value.isoformat(timespec='microseconds')}"
    return f"{type(value).__name__}:{value}"


def _rows(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def mismatch(df, con, sql: str) -> str | None:
    """What differs between a Spark frame and a query, types included."""
    answer = con.sql(sql)
    if sorted(df.columns) != sorted(answer.columns):
        return f"columns {sorted(df.columns)} != {sorted(answer.columns)}"
    a, b = _rows(df.columns, df.collect()), _rows(answer.columns, answer.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for left, right in zip(a, b):
        if left != right:
            return f"{sorted(df.columns)}\n  spark  {left}\n  oracle {right}"
    return None
