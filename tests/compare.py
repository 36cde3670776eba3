"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

SF_ROOT = os.environ.get("TESTDATA_DIR", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        if value == int(value) and abs(value) < 1e15:
            return int(value)
        return round(value, 6)
    if isinstance(value, bool):
        return int(value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def mismatch(df, con, sql) -> str | None:
    """None if the results agree, else a short account of the difference."""
    got_columns = df.columns
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    a, b = _sorted(got_columns, got), _sorted(want_columns, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        return f"{len(differing)} of {len(a)} rows differ, first {differing[0]}"
    types = {c: str(d[1]) for c, d in zip(want_columns, cursor.description)}
    return None if type_names(df, types) is None else type_names(df, types)


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def type_names(df, duck_types) -> str | None:
    for name, kind in df.dtypes:
        want = SAME_TYPE.get(kind)
        if want is not None and duck_types[name].upper() not in (want, "NUMBER", "STRING"):
            if duck_types[name].upper() != want:
                return f"column {name}: {kind} against {duck_types[name]}"
    return None
