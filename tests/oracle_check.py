"""Run registered Spark queries against their DuckDB oracles (like the driver).

usage: python tests/oracle_check.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if not hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    if sql is None:
        return f"{name}: rows={len(s_rows)} (no oracle) {ts:.1f}s"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"cols spark-only={sorted(set(s_cols) - set(d_cols))} duck-only={sorted(set(d_cols) - set(s_cols))}")
    else:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sv = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=repr)
        dv = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=repr)
        if len(sv) != len(dv):
            problems.append(f"rows spark={len(sv)} duck={len(dv)}")
        elif sv != dv:
            bad = [(a, b) for a, b in zip(sv, dv) if a != b]
            diffcols = set()
            for a, b in bad[:50]:
                for c, x, y in zip(order, a, b):
                    if x != y:
                        diffcols.add(c)
            problems.append(f"{len(bad)} rows differ; cols {sorted(diffcols)[:8]}; e.g. {bad[0][0][:6]} vs {bad[0][1][:6]}")
    status = "OK" if not problems else "FAIL " + "; ".join(problems)
    return f"{name}: {status} rows={len(s_rows)} {ts:.1f}s"


def main():
    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    import __spark_entry__ as E
    from yieldcast.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            line = compare(spark, con, name, fn, os_.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            line = f"{name}: ERROR {type(e).__name__}: {str(e)[:300]}"
        fails += ("FAIL" in line) or ("ERROR" in line)
        print(line, flush=True)
    print(f"failures: {fails}")


if __name__ == "__main__":
    main()
