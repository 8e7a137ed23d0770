"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in order of name, and values of one type per kind."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def _plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float)) or hasattr(value, "as_integer_ratio"):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    return str(value)


def close(left: tuple, right: tuple) -> bool:
    for a, b in zip(left, right, strict=True):
        if isinstance(a, float) and isinstance(b, float):
            if not math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6):
                return False
        elif a != b:
            return False
    return True


def compare(spark, run, sql: str, sf_dir: str) -> tuple[int, str | None, int]:
    """Row count, a description of the first difference, and rows not bit-equal."""
    df = run(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = connect(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    theirs = rows_of(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(mine), f"columns {sorted(df.columns)} != {sorted(names)}", 0
    if len(mine) != len(theirs):
        return len(mine), f"{len(mine)} rows != {len(theirs)} rows", 0
    inexact = 0
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            inexact += 1
            if not close(a, b):
                return len(mine), f"{a} != {b}", inexact
    return len(mine), None, inexact
