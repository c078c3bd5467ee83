"""Run queries() on Spark and oracle_sql() on DuckDB and compare the results.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Compares row count, column names and values (order-insensitive; floats rounded).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        if v.hour == 0 and v.minute == 0 and v.second == 0 and v.microsecond == 0:
            return v.date().isoformat()
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    res = {}
    for name, fn in qs.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            s_pd = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            res[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:400]}"
            print(name, res[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            res[name] = f"rows-only {len(s_pd)}"
            if verbose:
                print(f"{name:40s} rows-only n={len(s_pd)} {ts:.1f}s", flush=True)
            continue
        try:
            d_pd = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            res[name] = f"DUCK ERROR {str(e)[:400]}"
            print(name, res[name], flush=True)
            continue
        msg = []
        if sorted(s_pd.columns) != sorted(d_pd.columns):
            msg.append(f"cols spark={sorted(s_pd.columns)} duck={sorted(d_pd.columns)}")
        if len(s_pd) != len(d_pd):
            msg.append(f"rows spark={len(s_pd)} duck={len(d_pd)}")
        if not msg:
            a, b = rows_of(s_pd), rows_of(d_pd)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msg.append(f"values differ e.g. {diff}")
        res[name] = "OK" if not msg else "; ".join(msg)
        if verbose:
            print(f"{name:40s} {res[name][:600]} n={len(s_pd)} {ts:.1f}s", flush=True)
    return res


if __name__ == "__main__":
    from ceasekit.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    r = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in r.items() if v != "OK" and not v.startswith("rows-only")}
    print(f"\n{len(r) - len(bad)}/{len(r)} ok; failing: {sorted(bad)}")
