"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x)), x if x is not None else 0) for x in row)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return [cols[i] for i in order], out


def compare(spark_df, con, sql: str, max_show: int = 5):
    """Return None when equal, else a short description of the difference."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return f"row count differs: spark={len(sr)} duck={len(dr)}"
    diffs = [(a, b) for a, b in zip(sr, dr) if a != b]
    if diffs:
        return f"{len(diffs)} rows differ, e.g. {diffs[:max_show]}"
    return None
