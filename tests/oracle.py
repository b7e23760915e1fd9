"""Compare registered queries with their DuckDB oracle (row count, column
names, order-insensitive values). Used by the tests and runnable by hand:

    python tests/oracle.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in r))


def compare(spark, sf_dir: str, key: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries()[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = oracle_sql().get(key)
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"column mismatch {s_cols} vs {d_cols}"
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"value mismatch, first diffs {diff}"
    return res


def main(argv):
    from eventide.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    from __spark_entry__ import queries
    keys = argv[2:] or list(queries())
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, con)
        except Exception as e:  # report and go on
            r = {"key": k, "status": f"error {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
