"""Runs every registered query next to its SQL and compares rows: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dugout.catalog import ORACLES, QUERIES  # noqa: E402
from dugout.session import get_spark  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if isinstance(v, bool):
                v = int(v)
            elif isinstance(v, float):
                v = 0.0 if v == 0 else v
            vals.append(repr(v) if v is not None else "~")
        out.append("|".join(vals))
    return sorted(out)


def compare(spark, con, name: str, sf_dir: str) -> str:
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if name not in ORACLES:
        return f"rows-only {len(rows)} ({t1 - t0:.1f}s)"
    cur = con.execute(ORACLES[name])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"COLUMNS differ: only spark {sorted(set(df.columns) - set(want_cols))}, only sql {sorted(set(want_cols) - set(df.columns))}"
    a, b = canon(rows, df.columns), canon(want, want_cols)
    if len(a) != len(b):
        return f"ROWS differ: spark {len(a)} sql {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        names = sorted(df.columns)
        cells = {names[i] for x, y in bad[:200] for i, (u, v) in enumerate(zip(x.split("|"), y.split("|"))) if u != v}
        return f"VALUES differ in {len(bad)} of {len(a)} rows, columns {sorted(cells)}: {bad[0]}"
    return f"ok {len(a)} rows ({t1 - t0:.1f}s)"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for n in names:
        try:
            res = compare(spark, con, n, sf_dir)
        except Exception as e:  # noqa: BLE001
            res = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not res.startswith(("ok", "rows-only"))
        print(f"{n}: {res}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
