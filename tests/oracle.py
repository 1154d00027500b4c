"""Compare a named query with its SQL oracle on one scale factor."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb

TESTDATA = "/root/testdata"
# Spark type name -> the DuckDB types that hold the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and the bag of rows agree; otherwise what differs."""
    rel = con.sql(sql)
    want_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got_types = {c: SAME_TYPE.get(t, t) for c, t in df.dtypes}
    if want_types != got_types:
        return f"schema: got {got_types}, want {want_types}"
    got = bag(df.columns, (tuple(r) for r in df.collect()))
    want = bag(rel.columns, rel.fetchall())
    if got == want:
        return None
    missing, extra = want - got, got - want
    return (
        f"rows: got {got.total()}, want {want.total()}; "
        f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
    )


def utc(seconds: float) -> dt.datetime:
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc).replace(tzinfo=None)
