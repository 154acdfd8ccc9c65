"""Spark-vs-DuckDB comparison used by the tests and tools/check_oracle.py.

Columns are compared by name (sorted), rows as a multiset after the same
normalisation on both sides: floats rounded to 6 places, timestamps and
dates as ISO text, NaN and None as None.
"""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

SF_SMALL = "/root/testdata/sf0.001"

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
         "events", "documents", "embeddings", "pages", "benchmark", "labels",
         "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in VIEWS:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark_df, sql: str, con, max_show: int = 3):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:max_show]
        return False, f"values differ (sorted cols {sorted(s_cols)}): {diffs}"
    return True, f"{len(s_rows)} rows"
