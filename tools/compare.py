"""Run registered queries next to their oracle SQL in DuckDB and compare rows.

    python tools/compare.py [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidelog.plans import ORACLES, QUERIES  # noqa: E402
from tidelog.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"dec:{value}"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(plain(r[i]) for i in order) for r in rows])


def oracle_rows(sf, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    spark = local_session()
    bad = 0
    for key in args.keys or list(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[key](spark, args.sf)
            got = canonical(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - t0
            if key not in ORACLES:
                print(f"rows  {key} {len(got[1])} {took:.2f}s", flush=True)
                bad += not got[1]
                continue
            want = canonical(*oracle_rows(args.sf, ORACLES[key]))
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {key}: {str(exc)[:1500]}", flush=True)
            continue
        if got == want:
            print(f"ok    {key} {len(got[1])} {took:.2f}s", flush=True)
        else:
            bad += 1
            print(f"DIFF  {key}: {got[0]} vs {want[0]}, {len(got[1])} vs {len(want[1])} rows")
            a, b = set(got[1]), set(want[1])
            print("   spark only", sorted(a - b)[:3], "\n   oracle only", sorted(b - a)[:3], flush=True)
    print("failures:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
