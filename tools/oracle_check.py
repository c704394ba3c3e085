"""Run registered queries in Spark and their oracle SQL in DuckDB; compare rows.

Usage: python tools/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    scols = sdf.columns
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_v = ok_cols and ok_n and canon(srows, scols) == canon(drows, dcols)
    status = "OK " if ok_v else "BAD"
    print(f"{status} {name}: spark {len(srows)} rows {t1 - t0:.1f}s, duckdb {len(drows)} rows {t2 - t1:.1f}s"
          + ("" if ok_cols else f" cols spark={scols} duck={dcols}"))
    if not ok_v and ok_cols:
        a, b = canon(srows, scols), canon(drows, dcols)
        sa, sb = set(a), set(b)
        print("   only spark:", sorted(sa - sb, key=str)[:5])
        print("   only duck :", sorted(sb - sa, key=str)[:5])
    return ok_v


def main(argv):
    from daycast.session import local_session
    from daycast.plans.queries import QUERIES
    from daycast.plans.oracle_queries import ORACLE_SQL
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = []
    for n in names:
        if n not in ORACLE_SQL:
            print(f"--- {n}: no oracle SQL")
            continue
        try:
            if not compare(spark, con, n, QUERIES[n], ORACLE_SQL[n], sf_dir):
                bad.append(n)
        except Exception as e:  # report and go on with the next query
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:800]}")
            bad.append(n)
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
