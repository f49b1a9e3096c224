"""Run registered analyses in Spark and their SQL twins in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [key-substring ...]
Prints one line per key: OK / MISMATCH / ERROR with row counts and seconds.
"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])


def duck(sf_dir: str):
    from tessera.plans.inputs import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    try:
        f = float(v)
        if f == int(f) and not isinstance(v, str):
            return int(f)
        return round(f, 6)
    except (TypeError, ValueError, OverflowError):
        return str(v)


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for _, r in df.iterrows()]
    return cols, sorted(rows, key=repr)


def compare(spark, sf_dir, keys=None):
    from tessera.plans.catalog import oracle_sql, queries
    qs, sq = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in qs:
        if keys and not any(s in k for s in keys):
            continue
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir).toPandas()
            t1 = time.time()
            if k not in sq:
                results[k] = ("ROWS", len(sdf), None, t1 - t0)
                print(f"ROWS     {k:45s} spark={len(sdf)} {t1-t0:.1f}s", flush=True)
                continue
            odf = con.execute(sq[k]).df()
            sc, sr = canon(sdf)
            oc, orr = canon(odf)
            ok = sc == oc and sr == orr
            status = "OK" if ok else "MISMATCH"
            results[k] = (status, len(sdf), len(odf), t1 - t0)
            print(f"{status:8s} {k:45s} spark={len(sdf)} duck={len(odf)} {t1-t0:.1f}s", flush=True)
            if not ok:
                if sc != oc:
                    print("   cols", sc, oc)
                else:
                    diff = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
                    print("   first diffs", diff)
        except Exception as e:  # noqa: BLE001
            results[k] = ("ERROR", None, None, time.time() - t0)
            print(f"ERROR    {k:45s} {type(e).__name__}: {str(e)[:300]}", flush=True)
            traceback.print_exc(limit=3)
    return results


if __name__ == "__main__":
    from tessera.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] in ("MISMATCH", "ERROR")]
    print("summary:", len(res), "checked,", len(bad), "bad", bad)
