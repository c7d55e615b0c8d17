"""Compare a registered query with its SQL in DuckDB, order-insensitively."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.5f}"
    return str(value)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(_key(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted(tuple(_key(r[i]) for i in order) for r in result.fetchall())
    return [columns[i] for i in order], rows


def type_names(df, con, sql: str) -> list[tuple[str, str, str]]:
    """Columns whose types differ between Spark and DuckDB."""
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    }
    found = {d[0]: str(d[1]) for d in con.execute(sql).description}
    return [(c, t, found.get(c, "-")) for c, t in df.dtypes if same.get(t) != found.get(c)]
