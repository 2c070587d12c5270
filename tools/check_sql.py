"""Compare every query with its SQL in DuckDB: rows, column names and values."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import logging

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from campusloom.session import local_session  # noqa: E402
from registry import QUERIES  # noqa: E402
from registry.views import BASE  # noqa: E402


def norm(v):
    if v is None or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        return "∅" if math.isnan(v) else f"{v:.6f}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "is_integer") or type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return str(v)


def main() -> int:
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for t in BASE:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for n in names:
        q = QUERIES[n]
        try:
            t0 = time.time()
            df = q(spark, sf)
            cols = sorted(df.columns)
            got = sorted(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
            t1 = time.time()
            if not q.sql:
                print(f"rows  {n}: {len(got)} rows, {t1 - t0:.1f}s (no sql)")
                continue
            rel = duck.execute(q.sql)
            dcols = [d[0] for d in rel.description]
            idx = [dcols.index(c) for c in cols] if sorted(dcols) == cols else None
            want = rel.fetchall()
            t2 = time.time()
            if idx is None:
                bad += 1
                print(f"COLS  {n}: spark {cols} sql {sorted(dcols)}")
                continue
            want = sorted(tuple(norm(r[i]) for i in idx) for r in want)
            if got == want:
                print(f"ok    {n}: {len(got)} rows, spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s")
            else:
                bad += 1
                extra = [r for r in got if r not in set(want)][:3]
                lost = [r for r in want if r not in set(got)][:3]
                print(f"DIFF  {n}: spark {len(got)} sql {len(want)}\n   cols {cols}\n   only spark {extra}\n   only sql {lost}"[:1800])
        except Exception as e:
            bad += 1
            msg = str(e).strip().splitlines()
            print(f"FAIL  {n}: {type(e).__name__} {' '.join(msg[:6])[:900]}")
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print(f"{bad} bad of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
