"""Run registered queries against their DuckDB SQL twins (as the driver's
verify does): row count, column names, and order-insensitive values."""

from __future__ import annotations

import math
import os
import sys
import time

# Digits kept when comparing doubles; ORACLE_STRICT=1 compares exact values.
DIGITS = None if os.environ.get("ORACLE_STRICT") else 9

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v if DIGITS is None else round(v, DIGITS))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(cols)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    s, sc = rows_of(s_cols, s_rows)
    d, dc = rows_of(d_cols, d_rows)
    ok = sc == dc and len(s) == len(d) and s == d
    detail = ""
    if not ok:
        if sc != dc:
            detail = f"cols {sc} vs {dc}"
        elif len(s) != len(d):
            detail = f"rows {len(s)} vs {len(d)}"
        else:
            diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
            detail = f"values differ e.g. {diff}"
    return ok, len(s_rows), t_spark, detail


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from roundstats.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").getOrCreate()   # defaults, as a driver may use
    else:
        spark = get_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:28s} (no SQL twin)")
            continue
        try:
            ok, n, ts, detail = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, ts, detail = False, -1, 0.0, f"error {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={n:<7d} {ts:6.2f}s {detail}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
