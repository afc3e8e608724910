"""Run registered queries in Spark and their SQL twins in DuckDB; compare
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from tagwise.sources.tables import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest(), keyed


def compare(spark, con, name, fn, sql, sf_dir, show=3):
    t = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    ts = time.time() - t
    if sql is None:
        return {"name": name, "rows": len(s_rows), "ok": None, "spark_s": round(ts, 2)}
    t = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    td = time.time() - t
    hs, ks = digest(s_cols, s_rows)
    hd, kd = digest(d_cols, d_rows)
    ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and hs == hd
    out = {"name": name, "ok": ok, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_s": round(ts, 2), "duck_s": round(td, 2)}
    if not ok:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        sa, da = set(ks), set(kd)
        out["only_spark"] = sorted(sa - da)[:show]
        out["only_duck"] = sorted(da - sa)[:show]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from tagwise.session import build_session
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": repr(e)[:600]}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main()
