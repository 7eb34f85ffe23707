"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.10g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck_rows(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())
