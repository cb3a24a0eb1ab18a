"""Run registered queries on Spark and their oracle SQL on DuckDB over the
same parquet tables and compare: row count, column names, and the multiset
of rows (columns sorted by name, rows sorted).

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from lodestar.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return ("nan",)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=_key)


def compare(spark, con, name, sf_dir, sql):
    t0 = time.time()
    df = entry.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols, srows = canon(df.columns, srows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="no oracle")
    res = con.execute(sql)
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    t2 = time.time()
    dcols, drows = canon(dcols, drows)
    problems = []
    if scols != dcols:
        problems.append(f"columns {scols} != {dcols}")
    if len(srows) != len(drows):
        problems.append(f"rows {len(srows)} != {len(drows)}")
    if not problems and srows != drows:
        bad = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return dict(name=name, ok=not problems, rows=len(srows), spark_s=round(t1 - t0, 2),
                duck_s=round(t2 - t1, 2), problems=problems)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    from lodestar.session import get_session
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir, sqls.get(n))
        except Exception as e:  # report and go on
            r = dict(name=n, ok=False, problems=[f"{type(e).__name__}: {str(e)[:500]}"])
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
