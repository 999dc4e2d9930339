"""Spark-vs-DuckDB comparison used by the tests and by hand.

python tests/compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, tol: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") if tol else v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), tol)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), tol)
    return v


def _rows(cols, records, tol):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], tol) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def _kind_spark(t: str) -> str:
    t = t.lower()
    if t in ("tinyint", "smallint", "int", "bigint"):
        return "int"
    if t in ("float", "double"):
        return "float"
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("timestamp"):
        return "timestamp"
    return {"string": "string", "date": "date", "boolean": "bool"}.get(t, t)


def _kind_duck(t: str) -> str:
    t = t.upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "NUMBER"):
        return "int"
    if t in ("FLOAT", "DOUBLE"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "STRING": "string", "DATE": "date", "BOOLEAN": "bool"}.get(t, t.lower())


def compare(spark, sf_dir: str, key: str, con=None) -> dict:
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rec = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(key)
    res = {"key": key, "spark_rows": len(s_rec), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = None
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = [str(c[1]) for c in cur.description]
    d_rec = cur.fetchall()
    res["duck_sec"] = round(time.time() - t1, 2)
    res["duck_rows"] = len(d_rec)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    s_kinds = {f.name: _kind_spark(f.dataType.simpleString()) for f in sdf.schema.fields}
    d_kinds = {c: _kind_duck(t) for c, t in zip(d_cols, d_types)}
    res["type_mismatch"] = {c: (s_kinds[c], d_kinds.get(c)) for c in s_kinds
                            if c in d_kinds and s_kinds[c] != d_kinds[c]}
    if not res["cols_match"]:
        res["spark_cols"], res["duck_cols"] = sorted(s_cols), sorted(d_cols)
        return res
    for tol in (False, True):
        a, b = _rows(s_cols, s_rec, tol), _rows(d_cols, d_rec, tol)
        diff = sum(1 for x, y in zip(a, b) if x != y) + abs(len(a) - len(b))
        res["exact_diff" if not tol else "tol_diff"] = diff
        if diff and not tol:
            res["example"] = next(((x, y) for x, y in zip(a, b) if x != y), None)
    res["ok"] = res["spark_rows"] == res["duck_rows"] and res["tol_diff"] == 0 and not res["type_mismatch"]
    return res


if __name__ == "__main__":
    from platewise.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    keys = sys.argv[2:] or list(E.queries())
    spark = build_session("local[8]", 8)
    con = duck(sf)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf, k, con)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:800]}
        if not r.get("ok") and r.get("oracle", 1) is not None:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad, "of", len(keys))
