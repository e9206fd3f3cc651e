"""Compare registered queries with their SQL in DuckDB.

    python check.py [-s SF_DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import tempfile
import time
import traceback

import duckdb

from tallyloom import build_session
from tallyloom.plans import ORACLES, QUERIES, load_all

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 9)
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def compare(spark, con, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    if name not in ORACLES:
        return f"rows-only {len(rows)}" if rows else "EMPTY"
    start = time.time()
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"COLUMNS {cols} != {sorted(names)}"
    pos = [names.index(c) for c in cols]
    want = [tuple(norm(r[p]) for p in pos) for r in cur.fetchall()]
    took = time.time() - start
    if len(rows) != len(want):
        return f"ROWCOUNT spark={len(rows)} sql={len(want)}"
    kinds = {c: t for c, t in df.dtypes}
    got_s, want_s = sorted(map(repr, rows)), sorted(map(repr, want))
    bad = [(g, w) for g, w in zip(got_s, want_s) if g != w]
    if bad:
        return f"VALUES {len(bad)}/{len(rows)} {cols} e.g.\n   spark {bad[0][0][:600]}\n   sql   {bad[0][1][:600]}"
    sql_time = f" (sql {took:.1f}s)" if took > 2 else ""
    odd = [c for c, t in kinds.items() if t.startswith(("map", "struct", "array"))]
    return f"ok {len(rows)}" + (f" (nested {odd})" if odd else "") + sql_time + ("" if rows else " EMPTY")


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("-s", "--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true", help="session without any of our settings")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    load_all()
    shared = tempfile.mkdtemp(prefix="tallyloom-")  # one machine: any folder is shared
    if args.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false") \
            .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", shared).getOrCreate()
    else:
        spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                              spark__ui__showConsoleProgress="false", spark__driver__memory="12g", spark__checkpoint__dir=shared)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    picked = [q for q in QUERIES if not args.names or any(q.startswith(n) for n in args.names)]
    failed = 0
    for name in picked:
        start = time.time()
        try:
            msg = compare(spark, con, name, args.sf)
        except Exception as exc:  # report and go on with the next query
            msg = f"ERROR {type(exc).__name__}: {str(exc)[:900]}"
            if len(picked) == 1:
                traceback.print_exc()
        good = msg.startswith(("ok", "rows-only")) and "EMPTY" not in msg
        failed += not good
        print(f"{'   ' if good else 'BAD'} {name:38s} {time.time() - start:6.2f}s  {msg}", flush=True)
    print(f"{len(picked) - failed}/{len(picked)} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
