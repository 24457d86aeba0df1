"""Compare a Spark DataFrame with an SQL oracle run by DuckDB.

Row count, column names (sorted) and an order-insensitive multiset of
normalised row values must agree.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from starloom.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [cols[i] for i in order], out


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    oc, orows = _rows(o_cols, o_rows)
    info = {"spark_rows": len(sr), "oracle_rows": len(orows), "schema_ok": sc == oc,
            "rows_ok": len(sr) == len(orows), "values_ok": sr == orows}
    if not info["schema_ok"]:
        info["spark_cols"], info["oracle_cols"] = sc, oc
    elif not info["values_ok"]:
        so, ss = set(orows), set(sr)
        diff_s = [r for r in sr if r not in so][:3]
        diff_o = [r for r in orows if r not in ss][:3]
        info["spark_only"], info["oracle_only"] = diff_s, diff_o
    info["ok"] = info["schema_ok"] and info["rows_ok"] and info["values_ok"]
    return info
