"""Spark-vs-DuckDB comparison of registered queries (the driver's gate, locally).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = False


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x)), x if x is not None else 0) for x in row)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in data), key=_key)


def compare(spark, con, name: str, sf_dir: str, fn, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols, s_rows = rows_of_spark(df)
    t1 = time.time()
    d_cols, d_rows = rows_of_duck(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first diff: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows, spark {t1 - t0:.1f}s"


def main(argv):
    sys.path.insert(0, "/root/repo")
    from tidemark.session import local_session
    import __spark_entry__ as E

    global EXACT
    args = [a for a in argv[1:] if a != "--exact"]
    EXACT = "--exact" in argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name:28s} NO-ORACLE rows={df.count()}")
            continue
        try:
            ok, msg = compare(spark, con, name, sf_dir, qs[name], sqls[name])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
