"""Side-by-side comparison of a registered query with its SQL."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {table} as select * from read_parquet('{path}')")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda row: tuple((v is not None, type(v).__name__, v) if v is not None else (False, "", 0)
                                               for v in row))


_SAME = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP"}


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of rows, and what differs: names, types, or the first differing rows."""
    found = con.execute(sql)
    names, types = [d[0] for d in found.description], [str(d[1]) for d in found.description]
    expected = _sorted_rows(names, found.fetchall())
    actual = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        return len(actual), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours = {f.name: _SAME.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = dict(zip(names, types))
    problems += [f"type of {n}: {ours[n]} != {theirs[n]}" for n in names if ours[n] != theirs[n]]
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows != {len(expected)}")
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    if differing:
        problems.append(f"{len(differing)} rows differ, columns {sorted(names)}, first {differing[0]}")
    return len(actual), problems
