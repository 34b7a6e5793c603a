"""Side-by-side run of one named query in Spark and in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    return f"{type(value).__name__}:{value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else a description of the first difference."""
    left_names, left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    got = con.execute(sql)
    right_names, right = rows_of([d[0] for d in got.description], got.fetchall())
    if left_names != right_names:
        return f"columns differ: {sorted(set(left_names) ^ set(right_names))}"
    if len(left) != len(right):
        return f"rows differ: {len(left)} vs {len(right)}"
    if not left:
        return "both results are empty"
    for a, b in zip(left, right):
        if a != b:
            return "; ".join(f"{n}: {x} vs {y}" for n, x, y in zip(left_names, a, b) if x != y)
    return None
