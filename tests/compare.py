"""Run a registered query and its check SQL side by side and compare whole results."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb

import __spark_entry__ as entry_module

TESTDATA = os.environ.get("CALLSIEVE_TESTDATA", "/root/testdata")


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        rounded = round(value, 6)
        return f"f{0.0 if rounded == 0 else rounded!r}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else a short account of what differs."""
    df = entry_module.queries()[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry_module.oracle_sql()[name])
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        left, right = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} vs {len(want)} rows; spark only {sorted(left)[:2]}; sql only {sorted(right)[:2]}"
    if not got:
        return "no rows"
    return None
