"""Compare a registered query with its DuckDB statement, strictly by type and value."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame

# DuckDB type -> Spark type that must come out
TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float",
    "DATE": "date", "TIMESTAMP": "timestamp", "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, repr(0.0 if v == 0 else v))
    if isinstance(v, datetime.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    return (4, str(v))


def _table(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences, empty when equal."""
    rel = con.sql(sql)
    expected_types = dict(zip(rel.columns, (TYPES.get(str(t), str(t)) for t in rel.types)))
    actual_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = []
    if set(expected_types) != set(actual_types):
        return [f"columns differ: {sorted(set(expected_types) ^ set(actual_types))}"]
    for name, kind in expected_types.items():
        if actual_types[name] != kind:
            found.append(f"type of {name}: {actual_types[name]} instead of {kind}")
    actual = _table([tuple(r) for r in df.collect()], df.columns)
    expected = _table(rel.fetchall(), rel.columns)
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows instead of {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        names = sorted(df.columns)
        a, e = wrong[0]
        cells = [(n, x[1], y[1]) for n, x, y in zip(names, a, e) if x != y]
        found.append(f"{len(wrong)} rows differ, first (column, actual, expected): {cells[:4]}")
    return found
