"""Run every query and its SQL side by side: ``python tests/compare.py [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as e  # noqa: E402
from lexitrack.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir):
    """None if both sides agree, else a text that says how they differ."""
    df = e.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = e.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if not got:
        return "both empty" if not want else f"no rows / {len(want)}"
    if got == want:
        return None
    only = [r for r in got if r not in set(want)][:2]
    other = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} / {len(want)} rows; only Spark {str(only)[:700]}; only SQL {str(other)[:700]}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(sf)
    bad = 0
    for key in sys.argv[2:] or e.queries():
        t = time.time()
        try:
            problem = compare(spark, con, key, sf)
        except Exception as x:
            problem = f"{type(x).__name__}: {str(x)[:900]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.time() - t:.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
