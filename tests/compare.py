"""Strict comparison of a Spark query with its SQL: names, types, rows as a bag."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# DuckDB type -> Spark type it must meet.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    types = {column[0]: str(column[1]) for column in result.description}
    found = []
    if set(types) != set(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(types)}"]
    for name, kind in frame.dtypes:
        if TYPES.get(types[name]) != kind:
            found.append(f"{name}: {kind} != {types[name]}")
    names = list(types)
    expected = Counter(result.fetchall())
    actual = Counter(tuple(row) for row in frame.select(*[f"`{n}`" for n in names]).collect())
    if expected != actual:
        extra, lacking = actual - expected, expected - actual
        found.append(f"{sum(extra.values())} extra, {sum(lacking.values())} lacking of {sum(expected.values())}")
        found.append(f"extra {list(extra)[:2]} lacking {list(lacking)[:2]}")
    return found
