"""Run registered queries against their DuckDB oracles (like the driver's correctness gate).

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return f"DECIMAL:{v}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(norm(x)) for x in v) + "]"
    return str(v)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    scols = sorted(sdf.columns)
    ts = time.time() - t
    if sql is None:
        return f"{name}: rows-only {len(srows)} rows ({ts:.1f}s)", True
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    ok = True
    msg = []
    if sorted(dcols) != scols:
        ok = False
        msg.append(f"cols spark={scols} duck={sorted(dcols)}")
    if len(drows) != len(srows):
        ok = False
        msg.append(f"rows spark={len(srows)} duck={len(drows)}")
    if ok:
        sset = sorted(tuple(norm(r[c]) for c in scols) for r in srows)
        dset = sorted(tuple(norm(r[c]) for c in scols) for r in drows)
        if sset != dset:
            ok = False
            diff = [(a, b) for a, b in zip(sset, dset) if a != b][:3]
            msg.append(f"values differ, e.g. {diff}")
    return f"{name}: {'OK' if ok else 'MISMATCH'} {len(srows)} rows ({ts:.1f}s) {'; '.join(msg)}", ok


def main():
    import __spark_entry__ as E
    from basketlens.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    if os.environ.get("PLAIN_SESSION"):
        # the plainest session a caller could hand in: no time zone, AQE or checkpoint settings
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
        if os.environ.get("SESSION_TZ"):
            b = b.config("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
        if os.environ.get("ANSI_OFF"):
            b = b.config("spark.sql.ansi.enabled", "false")
        spark = b.getOrCreate()
    else:
        spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if os.environ.get("ORACLE_ONLY") and name not in oracles:
            continue
        try:
            line, ok = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:  # report and continue
            line, ok = f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}", False
        bad += not ok
        print(line, flush=True)
    print(f"{bad} failing")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
