"""Compare registered queries with their SQL in DuckDB: columns, types, and values as a multiset."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


KINDS = {
    "string": {"VARCHAR"}, "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "float": {"FLOAT"},
    "boolean": {"BOOLEAN"}, "timestamp_ntz": {"TIMESTAMP"}, "date": {"DATE"},
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str, show: int = 3) -> list[str]:
    """Empty when both sides agree."""
    relation = con.sql(sql)
    ours, theirs = sorted(df.columns), sorted(relation.columns)
    if ours != theirs:
        return [f"columns {ours} against {theirs}"]
    problems = []
    types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    for name, kind in df.dtypes:
        if types[name] not in KINDS.get(kind, {kind}):
            problems.append(f"type of {name}: {kind} against {types[name]}")
    table = df.select(*[f"`{c}`" for c in ours]).toArrow()
    left = Counter(tuple(map(_plain, r)) for r in zip(*[c.to_pylist() for c in table.columns]))
    quoted = ", ".join('"' + c + '"' for c in ours)
    right = Counter(tuple(map(_plain, r)) for r in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if left != right:
        problems.append(f"{sum(left.values())} rows against {sum(right.values())}")
        problems += [f"only Spark: {r}" for r in list((left - right).elements())[:show]]
        problems += [f"only SQL: {r}" for r in list((right - left).elements())[:show]]
    elif not left:
        problems.append("no rows")
    return problems
