"""Run registered queries beside their SQL and report differences by value."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if isinstance(value, float):
            return repr(value + 0.0)
        return str(value)

    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when names and all values agree, else what differs first."""
    mine, my_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs, their_rows = canonical(names, cursor.fetchall())
    if mine != theirs:
        return f"columns {mine} != {theirs}"
    if len(my_rows) != len(their_rows):
        return f"{len(my_rows)} rows != {len(their_rows)}"
    for a, b in zip(my_rows, their_rows):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(mine, a, b) if x != y]
            return f"first difference: {cells[:4]}"
    return None
