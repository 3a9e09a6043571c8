"""Run registered queries against their DuckDB text and compare values.

    python tests/oracle.py [sf0.01] [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, (int, float)):
        return (1, -1e308 if isinstance(v, float) and math.isnan(v) else float(v))
    return (2, str(v))


def _norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def compare(spark_rows, spark_cols, duck_rows, duck_cols) -> str:
    """'ok' or a description of the first difference."""
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns {sorted(spark_cols)} != {sorted(duck_cols)}"
    so = [spark_cols.index(c) for c in sorted(spark_cols)]
    do = [duck_cols.index(c) for c in sorted(duck_cols)]
    a = sorted(([_norm(r[i]) for i in so] for r in spark_rows), key=lambda r: [_key(v) for v in r])
    b = sorted(([_norm(r[i]) for i in do] for r in duck_rows), key=lambda r: [_key(v) for v in r])
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y and repr(x) != repr(y)]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ; columns {sorted(spark_cols)}; e.g. {bad[0][0]} | {bad[0][1]}"
    return "ok"


def run(spark, con, sf_dir, name, fn, sql):
    start = time.time()
    df = fn(spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    if sql is None:
        return f"rows={len(rows)}", took, len(rows)
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    return compare(rows, df.columns, cur.fetchall(), cols), took, len(rows)


def main(argv):
    import __spark_entry__ as entry
    from burstframe import build_session

    sf = argv[0] if argv else "sf0.01"
    parts = argv[1:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{TESTDATA}/{sf}"
    con = duck_connection(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            verdict, took, n = run(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as e:  # report and go on with the next query
            verdict, took, n = f"ERROR {type(e).__name__}: {str(e)[:400]}", 0.0, -1
        good = verdict == "ok" or (verdict.startswith("rows=") and n > 0)
        failed += not good
        print(f"{'PASS' if good else 'FAIL'} {name} {took:.1f}s n={n} {'' if verdict == 'ok' else verdict}", flush=True)
    print("failed:", failed)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
