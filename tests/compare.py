"""Compare registered queries with their SQL texts on one data folder."""

from __future__ import annotations

import datetime
import decimal
import os
import tempfile
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = os.environ.get("SHELFWISE_DATA", "/root/testdata")


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return f"dec:{v}"
    if isinstance(v, bool):
        return f"bool:{v}"
    if isinstance(v, float):
        return f"dbl:{v!r}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, queries, checks):
    """(seconds, rows, problem or None)."""
    start = time.time()
    df = queries[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if name not in checks:
        return spent, len(got), None
    cur = con.execute(checks[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return spent, len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return spent, len(got), None
    only_a, only_b = [x for x in a if x not in set(b)], [x for x in b if x not in set(a)]
    return spent, len(got), f"{len(a)} vs {len(b)} rows; {sorted(names)}; spark only {only_a[:3]}; sql only {only_b[:3]}"


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from shelfwise.session import build_session

    folder = f"{DATA}/{os.environ.get('SF', 'sf0.01')}"
    spark = build_session("compare", f"local[{os.environ.get("CORES", "8")}]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, checks = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:] or list(queries)
    bad = 0
    for name in [q for q in queries if q in wanted or any(w.endswith("*") and q.startswith(w[:-1]) for w in wanted)]:
        try:
            spent, n, problem = compare(spark, con, folder, name, queries, checks)
        except Exception as e:
            spent, n, problem = 0, -1, f"{type(e).__name__}: {str(e)[:1200]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {spent:6.2f}s {n:7d} {'' if name in checks else 'no sql'} {problem or ''}", flush=True)
    print("failed:", bad, "of", len(wanted))
