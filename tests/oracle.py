"""Compares registered queries with their SQL twins: python tests/oracle.py [sf] [names...]"""

import datetime as dt
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, fn, sql):
    df = fn(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return sum(got.values()), None
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return sum(got.values()), f"columns {sorted(df.columns)} vs {sorted(names)}"
    if got != want:
        return sum(got.values()), f"{sum(got.values())} rows vs {sum(want.values())}; only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
    return sum(got.values()), None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from listmill.engine import local_session

    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark, con = local_session(8), connect(folder)
    only = sys.argv[2:]
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, folder, fn, entry.oracle_sql().get(name))
        except Exception as e:
            n, problem = 0, f"{type(e).__name__}: {str(e)[:700]}"
        mark = "ok" if problem is None else "BAD"
        print(f"{mark:4} {time.time() - start:6.1f}s {n:7d} {name} {'' if name in entry.oracle_sql() else '(rows only)'} {problem or ''}"[:1500], flush=True)
