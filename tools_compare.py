"""Local stand-in for the driver's correctness check: run each registered
Spark query and its DuckDB oracle on the same parquet tables and compare
row count, column names and an order-insensitive hash of the values.

    python tools_compare.py <sf_dir> [--strict] [query ...]

Floats are compared after rounding to 4 decimals, or exactly with
``--strict`` (the registry's own rounding must then make them agree).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time

import duckdb
import pandas as pd


STRICT = False


def norm(v):
    if v is None or v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = (v + 0.0) if STRICT else round(v, 4) + 0.0
        return int(r) if r.is_integer() and abs(r) < 1e15 else r
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        ts = pd.Timestamp(v)
        return ts.date().isoformat() if ts == ts.normalize() else ts.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return int(v)
    return v


def digest(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(repr(tuple(norm(x) for x in rec)))
    rows.sort()
    return cols, hashlib.sha1("\n".join(rows).encode()).hexdigest(), rows


def main(sf_dir: str, names: list[str]):
    sys.path.insert(0, ".")
    from pansift.session import get_spark
    from pansift.plans.registry import load_all
    from pansift.plans.standins import TABLES
    spark = get_spark("local[8]", shuffle_partitions=8, conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.run(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = q.oracle()
        if sql is None:
            print(f"rows-only {name}: {len(sdf)} rows ({ts:.1f}s)")
            continue
        try:
            odf = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL {name}: {str(e)[:400]}")
            bad += 1
            continue
        c1, h1, r1 = digest(sdf)
        c2, h2, r2 = digest(odf)
        if c1 != c2 or len(sdf) != len(odf) or h1 != h2:
            bad += 1
            print(f"MISMATCH {name}: spark {len(sdf)} rows {c1}\n   oracle {len(odf)} rows {c2}")
            if c1 == c2:
                d1 = sorted(set(r1) - set(r2))[:3]
                d2 = sorted(set(r2) - set(r1))[:3]
                print("   spark-only:", d1, "\n   oracle-only:", d2)
        else:
            print(f"ok {name}: {len(sdf)} rows ({ts:.1f}s)")
    print(f"{bad} problems")


if __name__ == "__main__":
    args = sys.argv[1:]
    if "--strict" in args:  # hash floats exactly (as a strict checker would)
        STRICT = True
        args.remove("--strict")
    main(args[0], args[1:])
