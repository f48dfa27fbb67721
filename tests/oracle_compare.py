"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Compares column names, row count and the multiset of rows (values as text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def duck_conn(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, key, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"key": key, "ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
    res = {"key": key, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        res.update(ok=False, why=f"columns differ: spark={s_cols} duck={d_cols}")
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = [d_cols.index(s_cols[i]) for i in order]
    s_sorted = sorted(tuple(r[i] for i in order) for r in s_rows)
    d_sorted = sorted(tuple(r[i] for i in d_idx) for r in d_rows)
    if s_sorted == d_sorted:
        res["ok"] = True
        return res
    res["ok"] = False
    from collections import Counter

    cs, cd = Counter(s_sorted), Counter(d_sorted)
    only_s = list((cs - cd).elements())[:3]
    only_d = list((cd - cs).elements())[:3]
    names = [s_cols[i] for i in order]
    res["why"] = f"rows differ; cols={names}\n  spark-only={only_s}\n  duck-only={only_d}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    from estrella.session import build_session
    import __spark_entry__ as entry

    spark = build_session("local[8]", 8)
    con = duck_conn(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            r = compare(spark, con, key, qs[key], sqls.get(key), sf_dir)
        except Exception as e:  # report and go on
            r = {"key": key, "ok": False, "why": f"{type(e).__name__}: {str(e)[:600]}"}
        flag = {True: "OK  ", False: "FAIL", None: "ROWS"}[r["ok"]]
        print(f"{flag} {key:28s} rows={r.get('rows')} oracle={r.get('oracle_rows')} t={r.get('spark_s')}")
        if r["ok"] is False:
            bad += 1
            print("     ", r.get("why"))
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
