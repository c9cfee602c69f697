"""Run registered queries next to their SQL in DuckDB and compare rows.

usage: python tools/check_oracle.py [sf_dir] [query ...]
"""

import importlib.util
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from webgrain.session import build_session  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def entry_module():
    spec = importlib.util.spec_from_file_location("entry", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else 0.0 if v == 0 else v
    if isinstance(v, bool):
        return v
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def main(sf="/root/testdata/sf0.01", *only):
    entry = entry_module()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    spark = build_session()
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = []
    for name in only or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, sf)
            got = rows_of(df.columns, df.collect())
            t1 = time.time()
            if name not in sql:
                print(f"rows   {name:24} {len(got)} rows {t1 - t0:.1f}s", flush=True)
                continue
            res = con.execute(sql[name])
            cols = [d[0] for d in res.description]
            want = rows_of(cols, res.fetchall())
            t2 = time.time()
            same = sorted(cols) == sorted(df.columns) and got == want
            print(f"{'ok    ' if same else 'DIFFER'} {name:24} {len(got)} rows {t1 - t0:.1f}s sql {t2 - t1:.1f}s",
                  flush=True)
            if not same:
                bad.append(name)
                print("   columns", sorted(df.columns), sorted(cols), "rows", len(got), len(want))
                for side, a, b in (("spark only", got, want), ("sql only", want, got)):
                    other = set(map(repr, b))
                    print("   ", side, [str(x)[:300] for x in a if repr(x) not in other][:3])
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAILED {name:24} {type(e).__name__}: {str(e)[:600]}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
