"""Spark-vs-DuckDB comparison in the shape of the driver's correctness gate:
row count, column names, and an order-insensitive multiset of row values."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int | None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if digits is None else round(v, digits)
    if isinstance(v, Decimal):
        return str(v)
    return v


def rows_key(rows, cols, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark_df, con, sql: str, digits: int | None = None) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    a, b = rows_key(s_rows, s_cols, digits), rows_key(d_rows, d_cols, digits)
    out["match"] = a == b
    if a != b:
        out["only_spark"] = list((a - b).items())[:3]
        out["only_oracle"] = list((b - a).items())[:3]
        out["n_diff"] = sum((a - b).values())
    return out
