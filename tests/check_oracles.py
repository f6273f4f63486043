"""Compare registered queries with their SQL twins: python tests/check_oracles.py [dir] [name ...]."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from clusterloom.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "is_integer") or type(v).__name__ == "Decimal":
        return float(v)
    return v


def key(row):
    return tuple((v is None, str(type(v)) if isinstance(v, (str, bool)) else "", v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=key)


def compare(spark, con, name, sf):
    df = entry.queries()[name](spark, sf)
    got_cols, got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only: {len(got)}"
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"COLUMNS {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"ROWS {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"VALUES {len(bad)} of {len(got)}: {bad[:2]}" if bad else f"ok {len(got)}"


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in args or entry.queries():
        start = time.time()
        try:
            out = compare(spark, con, name, sf)
        except Exception as e:
            out = f"ERROR {type(e).__name__}: {str(e)[:400]}".replace("\n", " ")
        print(f"{name:26s} {time.time() - start:6.1f}s {out}", flush=True)


if __name__ == "__main__":
    main()
