"""Run registered queries and their DuckDB statements side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: rows, schema match, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm_value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(norm_value(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(rows, key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    from herald.catalog import QUERIES
    from herald.oracle import ORACLE
    con = duck(sf_dir)
    results = {}
    for name in names or list(QUERIES):
        if name not in ORACLE:
            continue
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir).toPandas()
            t1 = time.time()
            ddf = con.sql(ORACLE[name]).df()
            t2 = time.time()
            sc, sr = canon(sdf)
            dc, dr = canon(ddf)
            ok = (sc == dc, len(sr) == len(dr), sr == dr)
            results[name] = all(ok)
            if verbose:
                print(f"{name:26s} rows {len(sr):6d}/{len(dr):6d} schema={ok[0]} values={ok[2]} "
                      f"spark {t1 - t0:5.1f}s duck {t2 - t1:5.1f}s", flush=True)
                if not ok[0]:
                    print("   cols", sc, dc)
                elif not ok[2]:
                    a, b = set(sr), set(dr)
                    for x in list(a - b)[:2]:
                        print("   spark-only", repr(x)[:300])
                    for x in list(b - a)[:2]:
                        print("   duck-only ", repr(x)[:300])
        except Exception as e:  # noqa: BLE001
            results[name] = False
            print(f"{name:26s} ERROR {str(e)[:400]}", flush=True)
    return results


if __name__ == "__main__":
    from herald.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "12g"})
    res = compare(spark, sf, sys.argv[2:] or None)
    print("passed", sum(res.values()), "of", len(res))
