"""Spark result against DuckDB oracle: row count, column names, multiset of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(_norm(float(x)) for x in v.toArray())
    return v


def rows_of(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    out["values_match"] = out["cols_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    elif not out["values_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    return out
