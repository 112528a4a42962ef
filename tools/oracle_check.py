"""Run registered queries in Spark and their oracle SQL in DuckDB; compare rows, columns, values.

usage: python tools/oracle_check.py [sf_dir] [name-prefix ...] [--oracle-only]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return canon(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(canon(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(name, sdf, con, sql):
    t0 = time.time()
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = list(sdf.columns)
    ts = time.time() - t0
    if sql is None:
        return f"{name}: rows-only {len(s_rows)} rows ({ts:.1f}s)", True
    t1 = time.time()
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    to = time.time() - t1
    if sorted(s_cols) != sorted(o_cols):
        return f"{name}: COLUMNS differ spark={sorted(s_cols)} oracle={sorted(o_cols)}", False
    if len(s_rows) != len(o_rows):
        return f"{name}: ROWS differ spark={len(s_rows)} oracle={len(o_rows)}", False
    a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{name}: VALUES differ in {len(bad)} rows; first spark={bad[0][0]} oracle={bad[0][1]}", False
    return f"{name}: OK {len(s_rows)} rows (spark {ts:.1f}s, duckdb {to:.1f}s)", True


def main():
    import duckdb

    from adlytics.catalog import registry
    from adlytics.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = [a for a in sys.argv[2:] if not a.startswith("--")]
    oracle_only = "--oracle-only" in sys.argv
    spark = get_spark(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    queries, oracles = registry.load_all()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    n_ok = n_bad = 0
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        if oracle_only and name not in oracles:
            continue
        try:
            msg, ok = compare(name, fn(spark, sf_dir), con, oracles.get(name))
        except Exception as e:  # report and continue
            msg, ok = f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}", False
            if os.environ.get("TRACE"):
                traceback.print_exc()
        n_ok += ok
        n_bad += not ok
        print(msg, flush=True)
    print(f"== {n_ok} ok, {n_bad} failing")


if __name__ == "__main__":
    main()
