"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value.isoformat() if isinstance(value, datetime) else value


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted(tuple(_plain(row[n]) for n in names) for row in df.collect())


def duckdb_rows(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, _sorted(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
