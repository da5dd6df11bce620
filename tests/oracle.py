"""Run a query on Spark and its SQL on DuckDB and compare the two results."""

from __future__ import annotations

import math
import os

import duckdb

from wattweave.sources.views import DRIVER_TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(rows, order):
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def _kind(name: str) -> str:
    name = name.lower()
    return {"double": "float64", "float": "float32", "varchar": "string", "integer": "int", "timestamp": "timestamp_ntz"}.get(name, name) if name not in ("double", "float") else {"double": "float64", "float": "float32"}[name]


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between the two results; empty if they agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    actual = [tuple(r) for r in spark_df.collect()]
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: spark {sorted(spark_df.columns)} sql {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if _kind(kind) != _kind(kinds[name]):
            problems.append(f"type of {name}: spark {kind} sql {kinds[name]}")
    if len(actual) != len(expected):
        problems.append(f"rows: spark {len(actual)} sql {len(expected)}")
    shared = sorted(names)
    left = _rows(actual, [spark_df.columns.index(n) for n in shared])
    right = _rows(expected, [names.index(n) for n in shared])
    if left != right:
        diff = [(a, b) for a, b in zip(left, right) if a != b]
        problems.append(f"values: {len(diff)} rows differ")
        for a, b in diff[:3]:
            problems.append(str([(n, x, y) for n, x, y in zip(shared, a, b) if x != y][:6]))
    return problems
