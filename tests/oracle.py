"""Spark-vs-DuckDB comparison in the driver's manner: same row count, same column
names (sorted), same values as an unordered multiset (doubles to 1e-9 relative)."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, (int, float)):
        f = float(v)
        if math.isnan(f):
            return (2, "nan")
        return (1, f)
    return (3, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def _close(a, b):
    if a[0] != b[0]:
        return False
    if a[0] == 1:
        x, y = a[1], b[1]
        return x == y or abs(x - y) <= 1e-9 * max(1.0, abs(x), abs(y))
    return a == b


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short reason."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return f"columns {sorted(s_cols)} != {sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return f"rows {len(s_rows)} != {len(d_rows)}"
    a = sorted(_rows(s_cols, s_rows))
    b = sorted(_rows(d_cols, d_rows))
    for x, y in zip(a, b):
        if not all(_close(p, q) for p, q in zip(x, y)):
            return f"value {x} != {y}"
    return None
