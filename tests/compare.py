"""Runs a registered query on Spark and its expected SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, format(float(value) + 0.0, ".10g"))
    return (3, str(value))


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(_cell(r[n]) for n in names) for r in frame.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    header = [d[0] for d in cursor.description]
    names = sorted(header)
    at = [header.index(n) for n in names]
    return names, sorted(tuple(_cell(r[i]) for i in at) for r in cursor.fetchall())


def difference(frame, con, sql) -> str | None:
    """A short description of the first difference, or None."""
    left_names, left = spark_rows(frame)
    right_names, right = sql_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x[1], y[1]) for n, x, y in zip(left_names, a, b) if x != y]
        return f"{len(wrong)} of {len(left)} rows differ, e.g. {cells[:3]}"
    return None
