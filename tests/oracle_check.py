"""Run registered queries against their DuckDB oracles (like the driver's gate).

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from larkspur.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s_cols = df.columns
    if sql is None:
        return f"{name}: rows={len(rows)} (no oracle) {t1 - t0:.1f}s", True
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return f"{name}: COLUMNS differ spark={sorted(s_cols)} duck={sorted(d_cols)}", False
    a, b = canon(s_cols, rows), canon(d_cols, d_rows)
    if a != b:
        sa, sb = set(a), set(b)
        return (f"{name}: MISMATCH rows spark={len(a)} duck={len(b)} "
                f"only_spark={list(sa - sb)[:3]} only_duck={list(sb - sa)[:3]}"), False
    return f"{name}: ok rows={len(a)} {t1 - t0:.1f}s", True


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as ent
    from larkspur.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, os_ = ent.queries(), ent.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            msg, ok = compare(spark, con, name, qs[name], os_.get(name), sf_dir)
        except Exception as exc:  # report and continue
            msg, ok = f"{name}: ERROR {type(exc).__name__}: {str(exc)[:400]}", False
        bad += not ok
        print(msg, flush=True)
    print(f"failed: {bad}")
    from larkspur.session import drop_scratch
    drop_scratch(spark)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
