"""Comparison of a Spark result with the SQL equivalent on DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return repr(value)


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, None when nothing does."""
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    have_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if want_types != have_types:
        return f"schema: {sorted(set(have_types.items()) ^ set(want_types.items()))}"
    columns = sorted(rel.columns)
    rows = rel.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    want = sorted(tuple(plain(v) for v in r) for r in rows)
    have = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    if want == have:
        return None
    only_have, only_want = sorted(set(have) - set(want))[:2], sorted(set(want) - set(have))[:2]
    return f"{len(have)} rows against {len(want)}; {columns}; spark only {only_have}; sql only {only_want}"
