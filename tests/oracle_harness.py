"""Run a registered Spark query and its DuckDB oracle side by side.

Same contract as the driver's check: row count, column names, and an
order-insensitive hash of the values (columns sorted by name).  Floats are
hashed rounded to 6 places; ``ORACLE_EXACT=1`` hashes their exact repr.

    python tests/oracle_harness.py [names...] [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import argparse
import hashlib
import json
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("ORACLE_EXACT") else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    c = Counter("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for k in sorted(c):
        h.update(f"{k}#{c[k]}\n".encode())
    return h.hexdigest()[:16], c


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sh, sc = digest(scols, srows)
    dh, dc = digest(dcols, drows)
    out.update(duck_rows=len(drows), cols_match=sorted(scols) == sorted(dcols),
               hash_match=sh == dh, spark_cols=scols, duck_cols=dcols)
    if sh != dh:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        out.update(only_spark=only_s, only_duck=only_d)
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    import __spark_entry__ as entry
    from interlens.session import local_session
    spark = local_session(8)
    names = args.names or list(entry.queries())
    con = duck(args.sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, args.sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:500]}
        ok = r.get("hash_match", r.get("oracle") == "none")
        bad += not ok
        print(json.dumps(r, default=str), flush=True)
    print(f"# {len(names) - bad}/{len(names)} ok", flush=True)


if __name__ == "__main__":
    main()
