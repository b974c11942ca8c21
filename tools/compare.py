"""Run queries against their SQL: python tools/compare.py [name part ...] [--sf DIR]"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridgale.session import get_session  # noqa: E402
from registry import all_oracles, all_queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(norm(r[i])) for i in order) for r in rows)


def compare(spark, con, sf, name, fn, sql):
    start = time.time()
    df = fn(spark, sf)
    rows = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if sql is None:
        return spent, len(rows), "no sql"
    start = time.time()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    sql_spent = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return spent, len(rows), f"COLUMNS {sorted(df.columns)} / {sorted(columns)}"
    got, want = canonical_rows(df.columns, rows), canonical_rows(columns, want)
    if got == want:
        return spent, len(rows), f"ok (sql {sql_spent:.1f}s)"
    only = [g for g in got if g not in set(want)][:2]
    other = [w for w in want if w not in set(got)][:2]
    return spent, len(rows), f"DIFF {len(got)}/{len(want)} spark {only} sql {other}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("parts", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(args.sf), all_oracles(), 0
    for name, fn in all_queries().items():
        if args.parts and not any(name.startswith(p) for p in args.parts):
            continue
        try:
            spent, n, verdict = compare(spark, con, args.sf, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            spent, n, verdict = 0.0, 0, f"ERROR {type(e).__name__} {str(e)[:300]}"
        bad += not verdict.startswith(("ok", "no sql"))
        print(f"{name:40s} {spent:6.2f}s {n:7d} {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
