"""python tests/oracle_check.py [QUERY...]: each query beside its SQL at $SF_DIR (default sf0.01); prints what differs."""

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return tuple(plain(x) for x in v.asDict().items()) if hasattr(v, "asDict") else v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(str(plain(r[i])) for i in order) for r in data)


def main(names):
    import __spark_entry__ as e

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET threads=4")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}{'/*.parquet' if os.path.isdir(f) else ''}')")
    q, sql, bad = e.queries(), e.oracle_sql(), 0
    for n in names or q:
        t = time.time()
        try:
            df = q[n](spark, sf)
            got = rows(df.columns, [tuple(r) for r in df.collect()])
        except Exception as x:
            print(f"{n}: ERROR {str(x)[:1500]}", flush=True)
            bad += 1
            continue
        s = time.time() - t
        if n not in sql:
            print(f"{n}: {sum(got.values())} rows, {s:.1f} s, no SQL", flush=True)
            continue
        t = time.time()
        cur = con.execute(sql[n])
        cols = [d[0] for d in cur.description]
        want = rows(cols, cur.fetchall())
        same = got == want and sorted(cols) == sorted(df.columns)
        bad += not same
        print(f"{n}: {'ok' if same else 'DIFFERS'} {sum(got.values())} rows, {s:.1f} s, sql {time.time() - t:.1f} s", flush=True)
        if not same:
            print("  columns", sorted(df.columns), sorted(cols), "\n  only here", list((got - want).items())[:4], "\n  only sql", list((want - got).items())[:4], flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
