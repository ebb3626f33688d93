"""Comparison of a Spark query with its SQL on the same tables."""

from __future__ import annotations

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


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def spark_rows(frame):
    return sorted(frame.columns), rows(frame.columns, frame.collect())


def sql_rows(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows(columns, result.fetchall())
