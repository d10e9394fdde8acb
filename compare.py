"""Run registered queries against their SQL in DuckDB and report differences.

usage: python compare.py [sf] [--no-sql] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from seamark.plans import catalog
from seamark.plans.demo import TABLES
from seamark.session import local_session


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v) + 0.0
    return str(v)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    picks = [a for a in sys.argv[2:] if a != "--no-sql"]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    oracles = {} if "--no-sql" in sys.argv else catalog.oracle_sql()
    bad = 0
    for name, fn in catalog.queries().items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if "--no-sql" in sys.argv:
                df.write.format("noop").mode("overwrite").save()
                print(f"time  {name} {time.time() - start:.2f}s")
                sys.stdout.flush()
                continue
            rows = [r.asDict() for r in df.collect()]
            took = time.time() - start
            cols = sorted(df.columns)
            got = sorted(
                [tuple(normal(r[c]) for c in cols) for r in rows],
                key=lambda r: tuple((x is not None, str(x)) for x in r),
            )
            if name not in oracles:
                print(f"rows  {name} {len(got)} {took:.2f}s")
                continue
            start = time.time()
            cur = con.execute(oracles[name])
            names = [d[0] for d in cur.description]
            place = [names.index(c) for c in sorted(names)]
            want = sorted(
                [tuple(normal(r[i]) for i in place) for r in cur.fetchall()],
                key=lambda r: tuple((x is not None, str(x)) for x in r),
            )
            duck = time.time() - start
            if cols != sorted(names):
                bad += 1
                print(f"COLS  {name} {cols} {sorted(names)}")
            elif got != want:
                bad += 1
                diff = [(a, b) for a, b in zip(got, want) if a != b][:3]
                print(f"DIFF  {name} rows {len(got)} {len(want)} {cols}")
                for a, b in diff:
                    print("   spark", a)
                    print("   duck ", b)
            else:
                print(f"ok    {name} {len(got)} {took:.2f}s duck {duck:.2f}s")
        except Exception as err:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name} {type(err).__name__}: {str(err)[:600]}")
        sys.stdout.flush()
    print("bad:", bad)
    os._exit(1 if bad else 0)


if __name__ == "__main__":
    main()
