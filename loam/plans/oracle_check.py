"""Local stand-in for the driver's correctness gate: Spark result vs DuckDB SQL.

Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name, floats rounded to 9 significant digits).
"""

from __future__ import annotations

import hashlib
import math
import os

import duckdb
import pandas as pd

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return f"{v:.9g}"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return str(v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return _norm(float(v))
    except Exception:
        pass
    return str(v)


def frame_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort()
    return out


def compare(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    res = {
        "spark_rows": len(s),
        "oracle_rows": len(d),
        "columns_match": sorted(s.columns) == sorted(d.columns),
        "spark_cols": sorted(s.columns),
        "oracle_cols": sorted(d.columns),
    }
    if res["columns_match"]:
        rs, rd = frame_rows(s), frame_rows(d)
        res["hash_match"] = hashlib.sha1(repr(rs).encode()).hexdigest() == hashlib.sha1(repr(rd).encode()).hexdigest()
        if not res["hash_match"]:
            ss, dd = set(rs), set(rd)
            res["only_spark"] = sorted(ss - dd)[:5]
            res["only_oracle"] = sorted(dd - ss)[:5]
    else:
        res["hash_match"] = False
    res["ok"] = res["columns_match"] and res["hash_match"] and res["spark_rows"] == res["oracle_rows"]
    return res
