"""Compare a registered query with its SQL in DuckDB, value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, query, sql, folder):
    """(columns equal, row counts, values equal) of both sides."""
    frame = query(spark, folder)
    left = rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    right = rows(names, result.fetchall())
    return sorted(frame.columns) == sorted(names), (len(left), len(right)), left == right, (left, right)
