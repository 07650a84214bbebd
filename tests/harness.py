"""Side-by-side check of a registered Spark query against its DuckDB oracle.

Mirrors the driver's gate: same column names (compared sorted), same row
count, same order-insensitive hash of the values.
"""
from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

from quire.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _canon(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def digest(cols, rows) -> tuple[list[str], int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_canon(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [cols[i] for i in order], len(lines), h


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    s, d = digest(scols, srows), digest(dcols, drows)
    out = {"name": name, "cols_ok": s[0] == d[0], "rows_spark": s[1], "rows_duck": d[1], "hash_ok": s[2] == d[2]}
    out["ok"] = out["cols_ok"] and s[1] == d[1] and out["hash_ok"]
    if not out["ok"]:
        out["spark_cols"], out["duck_cols"] = s[0], d[0]
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
        ls = sorted("\x1f".join(_canon(r[i]) for i in order_s) for r in srows)
        ld = sorted("\x1f".join(_canon(r[i]) for i in order_d) for r in drows)
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        out["only_spark"], out["only_duck"] = only_s, only_d
    return out
