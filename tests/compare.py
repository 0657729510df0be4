"""Comparing a Spark result with the same query in DuckDB."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when names, rows and values are equal, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} and {sorted(relation.columns)}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} and {sum(theirs.values())} rows; "
        f"ours only {list((ours - theirs).items())[:3]}, theirs only {list((theirs - ours).items())[:3]}"
    )


# What one engine calls a type, in the other's words.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def type_difference(df, con, sql: str) -> str | None:
    relation = con.sql(sql)
    theirs = {n: TYPES.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    ours = dict(df.dtypes)
    differing = {n: (ours[n], theirs.get(n)) for n in ours if ours[n] != theirs.get(n)}
    return str(differing) if differing else None
