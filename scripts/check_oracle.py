"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from pulsegrid.plans.catalog import ORACLE, QUERIES  # noqa: E402
from pulsegrid.session import local_session  # noqa: E402
from pulsegrid.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("EXACT") else round(v, 9)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    try:
        import numpy as np

        if isinstance(v, np.generic):
            return norm(v.item())
    except Exception:
        pass
    return v


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for r in df[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in r))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    ok = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = QUERIES[n](spark, sf_dir)
            sp = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{n:34s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        t1 = time.time()
        if n not in ORACLE:
            print(f"{n:34s} rows={len(sp)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            dd = con.execute(ORACLE[n]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"{n:34s} DUCKDB-ERROR {str(e)[:300]}")
            continue
        sc, sr = rows(sp)
        dc, dr = rows(dd)
        status = "OK" if (sc == dc and sr == dr) else "MISMATCH"
        if status == "OK":
            ok += 1
        print(f"{n:34s} {status} spark={len(sr)} duck={len(dr)} {t1 - t0:.1f}s")
        if status != "OK":
            if sc != dc:
                print("   cols spark:", sc, "\n   cols duck: ", dc)
            else:
                s1, s2 = set(sr), set(dr)
                print("   only spark:", list(s1 - s2)[:3])
                print("   only duck: ", list(s2 - s1)[:3])
            print("   spark types:", dict(sdf.dtypes))
            print("   duck types: ", dict(zip(dd.columns, [str(x) for x in dd.dtypes])))
    print(f"{ok}/{len(names)} OK")


if __name__ == "__main__":
    main()
