"""Run every ``queries()`` entry in Spark and its ``oracle_sql()`` twin in
DuckDB on the same parquet folder; compare columns, row counts and sorted
values. ``python tests/oracle_check.py [sf_dir] [name ...]``"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if hasattr(v, "as_tuple"):  # Decimal
        return str(v)
    return v


def rows_of(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, q, sql, sf_dir):
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    scols = sorted(sdf.columns)
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    ok = sorted(dcols) == scols and len(drows) == len(srows)
    detail = ""
    if sorted(dcols) != scols:
        detail = f"cols spark={scols} duck={sorted(dcols)}"
    elif len(drows) != len(srows):
        detail = f"rows spark={len(srows)} duck={len(drows)}"
    else:
        a, b = rows_of(srows, scols), rows_of(drows, scols)
        if a != b:
            ok = False
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            detail = f"values differ e.g. {diff}"
    return dict(name=name, ok=ok, rows=len(srows), spark_s=round(t1 - t0, 2), detail=detail)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from __spark_entry__ import oracle_sql, queries
    from rootsweep.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, q in queries().items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, con, name, q, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = dict(name=name, ok=False, detail=f"{type(e).__name__}: {str(e)[:300]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
