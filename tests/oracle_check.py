"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [--exact] [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, order-insensitive values.
Floats are compared to 6 decimals, or bit for bit with ``--exact``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, ".")

from hearth.plans import registry  # noqa: E402
from hearth.sources.tables import DRIVER_TABLES  # noqa: E402
from hearth.session import build_session  # noqa: E402


EXACT = False


def norm(v, exact=None):
    exact = EXACT if exact is None else exact
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v if exact else round(v, 6)))
    if hasattr(v, "is_integer") or isinstance(v, int):
        if isinstance(v, (int, bool)):
            return (1, str(int(v)))
        return (1, repr(float(v) if exact else round(float(v), 6)))
    return (1, str(v))


def canon(cols, rows, exact=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i], exact) for i in order) for r in rows), [cols[i] for i in order]


def oracle_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def main():
    global EXACT
    args = sys.argv[1:]
    if args and args[0] == "--exact":
        EXACT, args = True, args[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    reg = registry.load_all()
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names or list(reg):
        t0 = time.time()
        try:
            df = registry.build(name, spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"\nFAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        sql = registry.oracle(name)
        if sql is None:
            print(f"rows {name}: {len(srows)} rows (no oracle) {time.time()-t0:.1f}s")
            continue
        try:
            ocols, orows = oracle_rows(con, sql)
        except Exception as e:
            print(f"\nFAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        a, ac = canon(scols, srows)
        b, bc = canon(ocols, orows)
        if ac != bc:
            print(f"\nFAIL {name}: columns spark={ac} oracle={bc}")
            bad += 1
        elif a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"\nFAIL {name}: rows spark={len(a)} oracle={len(b)} first diffs={diff}")
            bad += 1
        else:
            print(f"\nok   {name}: {len(a)} rows {time.time()-t0:.1f}s")
    print("bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
