"""Differential check: each registered query against its DuckDB twin.

Usage::

    python -m marquee.plans.check [--sf-dir DIR] [name-substring ...]

Runs the Spark query and the oracle SQL over the same parquet tables and
compares row count, column names, value classes and an order-insensitive
multiset of normalised rows.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb
import numpy as np

from marquee.plans import registry
from marquee.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float | np.floating):
        f = float(v)
        if math.isnan(f):
            return None
        return ("f", round(f, digits) + 0.0)
    if isinstance(v, decimal.Decimal):
        return ("f", round(float(v), digits) + 0.0)
    if isinstance(v, bool | np.bool_):
        return ("b", bool(v))
    if isinstance(v, int | np.integer):
        return ("i", int(v))
    if isinstance(v, str):
        return ("s", v)
    if isinstance(v, bytes | bytearray):
        return ("y", bytes(v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((str(k), _norm(x, digits)) for k, x in v.items())))
    if isinstance(v, list | tuple | np.ndarray):
        return ("a", tuple(_norm(x, digits) for x in v))
    if hasattr(v, "asDict"):
        return ("r", tuple(_norm(x, digits) for x in v))
    if isinstance(v, dt.datetime | np.datetime64):
        import pandas as pd
        ts = pd.Timestamp(v)
        if ts.tzinfo is not None:
            ts = ts.tz_convert("UTC").tz_localize(None)
        return ("t", ts.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, dt.timedelta):
        return ("td", v.total_seconds())
    return ("o", str(v))


def _rows(names, rows, digits):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def _classes(rows, n):
    cls = [set() for _ in range(n)]
    for r in rows:
        for i, v in enumerate(r):
            nv = _norm(v, 6)
            if nv is not None:
                cls[i].add(nv[0])
    return cls


def compare(spark, con, name, sf_dir, digits=6):
    e = registry.load_all()[name]
    t0 = time.time()
    sdf = e.fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if not e.oracle:
        return {"name": name, "status": "rows-only", "rows": len(s_rows), "sec": round(t1 - t0, 2)}
    rel = con.sql(e.oracle)
    d_names = list(rel.columns)
    d_rows = rel.fetchall()
    out = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "sec": round(t1 - t0, 2)}
    if sorted(s_names) != sorted(d_names):
        out.update(status="schema", spark_cols=s_names, oracle_cols=d_names)
        return out
    if len(s_rows) != len(d_rows):
        out.update(status="count")
        return out
    sc = _classes(s_rows, len(s_names))
    dc = _classes(d_rows, len(d_names))
    s_map = dict(zip(s_names, sc))
    d_map = dict(zip(d_names, dc))
    bad = {c: (sorted(s_map[c]), sorted(d_map[c])) for c in s_names
           if s_map[c] and d_map[c] and s_map[c] != d_map[c]}
    if bad:
        out.update(status="types", detail=str(bad)[:300])
        return out
    a, b = _rows(s_names, s_rows, digits), _rows(d_names, d_rows, digits)
    if a != b:
        diff_a = list((a - b).elements())[:3]
        diff_b = list((b - a).elements())[:3]
        out.update(status="values", spark_only=str(diff_a)[:600], oracle_only=str(diff_b)[:600])
        return out
    out["status"] = "ok"
    return out


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--digits", type=int, default=6)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from marquee.session import build_session
    spark = build_session()
    con = duck(a.sf_dir)
    entries = registry.load_all()
    names = [n for n in entries if not a.names or any(s in n for s in a.names)]
    summary = Counter()
    for n in names:
        try:
            r = compare(spark, con, n, a.sf_dir, a.digits)
        except Exception as ex:  # report and go on
            r = {"name": n, "status": "error", "detail": f"{type(ex).__name__}: {str(ex)[:400]}"}
        summary[r["status"]] += 1
        if r["status"] not in ("ok", "rows-only"):
            print(r, flush=True)
        elif os.environ.get("VERBOSE"):
            print(r, flush=True)
    print(dict(summary), "of", len(names), flush=True)
    spark.stop()
    return 0 if summary.get("ok", 0) + summary.get("rows-only", 0) == len(names) else 1


if __name__ == "__main__":
    sys.exit(main())
