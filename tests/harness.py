"""Runs registered queries next to their SQL counterparts and compares all values."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, bool):
        return f"bool:{value}"
    return None if value is None else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, v or "") for v in r))


SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def types_of(df, con, sql) -> str:
    ours = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    return "" if ours == theirs else f"types {set(ours.items()) ^ set(theirs.items())}"


def compare(spark, con, sf_dir, query, sql) -> str:
    """Empty text when both results are the same, else what differs."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    if not ours[1]:
        return "no rows to compare"
    if types_of(df, con, sql):
        return types_of(df, con, sql)
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(wrong)} of {len(ours[1])} rows, first {wrong[0]} in {ours[0]}" if wrong else ""
