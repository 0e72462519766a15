"""Run registered queries on Spark and their oracle SQL on DuckDB, compare.

Comparison: same column names (sorted), same row count, and the same
multiset of rows after normalising values (floats rounded, timestamps as
ISO text). Usable from pytest and as a script:

    python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def compare(spark, key: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"key": key, "rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out["oracle_rows"] = len(o_rows)
    if sorted(s_cols) != sorted(o_cols):
        out["status"] = f"columns differ: {sorted(s_cols)} vs {sorted(o_cols)}"
        return out
    a = Counter(normalise(s_cols, s_rows))
    b = Counter(normalise(o_cols, o_rows))
    if a == b:
        out["status"] = "match"
    else:
        miss = list((b - a).elements())[:3]
        extra = list((a - b).elements())[:3]
        out["status"] = f"values differ: oracle-only {miss} spark-only {extra}"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from forumlens.session import get_session
    spark = get_session("local[8]", 8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, k, qs[k], orc.get(k), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"error {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "no-oracle")
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
