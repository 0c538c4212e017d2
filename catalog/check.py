"""Run registered queries in Spark and their SQL in DuckDB and compare them.

    python -m catalog.check [-d DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def session(cpus: str = "8"):
    from pyspark.sql import SparkSession
    from plumbline.session import configure

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("check")
    spark = (
        configure(builder).config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def kinds(rows, n):
    out = []
    for i in range(n):
        out.append(sorted({type(r[i]).__name__ for r in rows if r[i] is not None}))
    return out


def main() -> int:
    from catalog import load
    from catalog.registry import QUERIES, oracle_sql

    load()
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("-d", "--dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    oracles = oracle_sql()
    spark, con = session(), duck(args.dir)
    bad = 0
    for name in args.names or list(QUERIES):
        began = time.time()
        try:
            df = QUERIES[name](spark, args.dir)
            got = [tuple(r) for r in df.collect()]
        except Exception as exc:  # report and go on to the next query
            bad += 1
            print(f"ERR   {name}: {str(exc)[:600]}", flush=True)
            continue
        took = time.time() - began
        if name not in oracles:
            print(f"rows  {name}: {len(got)} rows {took:.1f}s", flush=True)
            continue
        try:
            began = time.time()
            res = con.execute(oracles[name])
            cols = [d[0] for d in res.description]
            want = res.fetchall()
            duck_took = time.time() - began
        except Exception as exc:
            bad += 1
            print(f"SQL   {name}: {str(exc)[:600]}", flush=True)
            continue
        if sorted(cols) != sorted(df.columns):
            bad += 1
            print(f"COLS  {name}: {sorted(df.columns)} vs {sorted(cols)}", flush=True)
            continue
        a, b = rows_of(df.columns, got), rows_of(cols, want)
        ka = dict(zip(df.columns, kinds(got, len(cols))))
        kb = dict(zip(cols, kinds(want, len(cols))))
        types = {c: (ka[c], kb[c]) for c in cols if ka[c] != kb[c]}
        if a != b:
            bad += 1
            left, right = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
            print(f"DIFF  {name}: {len(a)} vs {len(b)} rows; columns {sorted(cols)}", flush=True)
            for x in left:
                print("   spark", x)
            for x in right:
                print("   duck ", x)
        else:
            note = f" TYPES {types}" if types else ""
            print(f"ok    {name}: {len(a)} rows spark {took:.1f}s duck {duck_took:.1f}s{note}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
