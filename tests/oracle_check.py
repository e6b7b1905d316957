"""Run registered Spark queries against their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name), the way the driver's correctness gate does.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillroll.sources.tables import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def table_digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(row[i]) for i in order) for row in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, name, q, sf_dir):
    t0 = time.time()
    sdf = q.spark(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(q.oracle())
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    sh, sl = table_digest(s_cols, s_rows)
    dh, dl = table_digest(d_cols, d_rows)
    ok = ok_cols and len(s_rows) == len(d_rows) and sh == dh
    detail = ""
    if not ok:
        if not ok_cols:
            detail = f" cols spark-only={sorted(set(s_cols)-set(d_cols))} duck-only={sorted(set(d_cols)-set(s_cols))}"
        else:
            ds, dd = sorted(set(sl) - set(dl)), sorted(set(dl) - set(sl))
            cols = sorted(s_cols)
            detail = f" rows {len(s_rows)} vs {len(d_rows)}; diff {len(ds)}/{len(dd)}\n   cols={cols}"
            for a, b in list(zip(ds, dd))[:3]:
                detail += f"\n   S {a}\n   D {b}"
    print(f"{'OK  ' if ok else 'FAIL'} {name:26s} rows={len(s_rows):6d} spark={t1-t0:5.1f}s duck={t2-t1:4.1f}s{detail}", flush=True)
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    from tillroll import local_session
    from tillroll.plans.registry import REGISTRY

    spark = local_session(shuffle_partitions=8)
    con = duck(sf_dir)
    bad = []
    for name, q in REGISTRY.items():
        if names and name not in names:
            continue
        if q.sql is None:
            t0 = time.time()
            n = q.spark(spark, sf_dir).count()
            print(f"ROWS {name:26s} rows={n:6d} spark={time.time()-t0:5.1f}s", flush=True)
            continue
        try:
            if not compare(spark, con, name, q, sf_dir):
                bad.append(name)
        except Exception as exc:  # report and continue
            print(f"ERR  {name}: {type(exc).__name__}: {str(exc)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
