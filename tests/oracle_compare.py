"""Run a registered query in Spark and its SQL twin in DuckDB; compare.

Mirrors the driver's check: row count, column names, and an order-insensitive
hash of the values (columns sorted by name). Floats are compared exactly and,
for diagnosis, also after rounding to 9 significant digits.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits:
            return float(f"{v:.{digits}g}")
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), digits)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return repr(float(v))
    except Exception:
        pass
    return v


def _digest(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted(repr(tuple(_norm(r[i], digits) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keys).encode()).hexdigest()[:16]


def compare(spark, name, sf_dir, con=None):
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    sql = oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out.update(duck_rows=len(drows), cols_match=sorted(scols) == sorted(dcols),
               exact=_digest(scols, srows) == _digest(dcols, drows),
               close=_digest(scols, srows, 9) == _digest(dcols, drows, 9))
    if not out["cols_match"]:
        out["cols"] = (sorted(scols), sorted(dcols))
    if not out["exact"]:
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
        ss = sorted(repr(tuple(_norm(r[i], None) for i in order_s)) for r in srows)
        ds = sorted(repr(tuple(_norm(r[i], None) for i in order_d)) for r in drows)
        out["only_spark"] = [x for x in ss if x not in set(ds)][:3]
        out["only_duck"] = [x for x in ds if x not in set(ss)][:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    sys.path.insert(0, ".")
    from flowscope.session import build_session
    from __spark_entry__ import queries
    if os.environ.get("PLAIN_SESSION"):  # a default session, as an external driver may build it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        if os.environ.get("SESSION_TZ"):
            spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    else:
        spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for name in names or list(queries()):
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "error": repr(e)[:400]}
        ok = r.get("exact") or r.get("oracle") == "none"
        bad += not ok
        print(("OK  " if ok else "BAD ") + repr(r), flush=True)
    print(f"{bad} not exact")


if __name__ == "__main__":
    main(sys.argv)
