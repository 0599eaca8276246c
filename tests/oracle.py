"""Run registered queries next to their SQL oracle and compare rows. Usage: python tests/oracle.py [sf] [names...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TILLWORKS_TESTDATA", "/root/testdata")


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def key(row):
    return tuple((x is None, str(type(x).__name__) if not isinstance(x, (int, float)) else "n",
                  (round(x, 4) if isinstance(x, float) else x) if x is not None else 0) for x in row)


def close(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


def compare(df, con, sql):
    """None when equal, else a text saying what differs. Second value: rows whose floats differ only in the last digits."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right_raw = cur.fetchall()
    left_names = df.columns
    if sorted(left_names) != sorted(names):
        return f"columns differ: only spark {set(left_names) - set(names)}, only sql {set(names) - set(left_names)}", 0
    order = sorted(names)
    left = [tuple(norm(r[n]) for n in order) for r in df.collect()]
    pos = [names.index(n) for n in order]
    right = [tuple(norm(r[p]) for p in pos) for r in right_raw]
    if len(left) != len(right):
        return f"rows differ: spark {len(left)} sql {len(right)}", 0
    left.sort(key=key)
    right.sort(key=key)
    near = 0
    for a, b in zip(left, right):
        if a != b or any(type(x) is not type(y) for x, y in zip(a, b)):
            if not all(close(x, y) for x, y in zip(a, b)):
                return f"row differs:\n spark {dict(zip(order, a))}\n sql   {dict(zip(order, b))}", near
            near += 1
    return None, near


def main():
    from tillworks.plans import load_all
    from tillworks.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = f"{TESTDATA}/sf{sf}"
    queries, oracles = load_all()
    con = duck(sf_dir)
    spark = build_session(8)
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("TILLWORKS_TZ", "UTC"))
    spark.sparkContext.setLogLevel("ERROR")
    bad = []
    for name, fn in queries.items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                msg, near = compare(df, con, oracles[name])
            else:
                msg, near = None, 0
                print(name, "rows", df.count(), "(no oracle)")
        except Exception as e:  # report and go on
            msg, near = f"{type(e).__name__}: {str(e)[:900]}", 0
        took = time.time() - t
        n = 0 if msg else con.execute(f"SELECT count(*) FROM ({oracles[name]}) x").fetchall()[0][0] if name in oracles else -1
        print(f"{'ok ' if msg is None else 'BAD'} {name:28s} {took:6.2f}s rows={n} near={near} {msg or ''}", flush=True)
        if msg:
            bad.append(name)
    print("bad:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
