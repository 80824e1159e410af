"""Compare a Spark result with the SQL oracle: names, row count, and values in any order."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, db, sql: str) -> list[str]:
    result = db.execute(sql)
    expected_names = [d[0] for d in result.description]
    expected = _rows(expected_names, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if sorted(expected_names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(expected_names)}")
    if len(expected) != len(actual):
        found.append(f"rows {len(actual)} != {len(expected)}")
    pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
    found += [f"spark {a} != sql {e}" for a, e in pairs[:3]]
    return found
