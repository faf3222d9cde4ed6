"""Spark result against DuckDB's, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    spark_kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if spark_kinds.get(kind) != kinds[name]:
            return f"type of {name}: {kind} / {kinds[name]}"
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows(names, result.fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} / {sum(theirs.values())} rows; only Spark {list(extra.items())[:2]}; "
            f"only SQL {list(missing.items())[:2]}"
        )
    if not ours:
        return "no rows"
    return None
