"""Run named queries on Spark and their SQL on DuckDB and compare the results.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from __spark_entry__ import oracle_sql, queries

    qs, oracle = queries(), oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spd = sdf.toPandas()
        except Exception as exc:  # noqa: BLE001
            report[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            if verbose:
                print(name, report[name], flush=True)
            continue
        dt = time.time() - t0
        if name not in oracle:
            report[name] = f"rows={len(spd)} (no oracle)"
        else:
            try:
                dpd = con.execute(oracle[name]).fetchdf()
            except Exception as exc:  # noqa: BLE001
                report[name] = f"DUCK ERROR {type(exc).__name__}: {str(exc)[:300]}"
                if verbose:
                    print(name, report[name], flush=True)
                continue
            if sorted(spd.columns) != sorted(dpd.columns):
                report[name] = f"COLUMNS spark={sorted(spd.columns)} duck={sorted(dpd.columns)}"
            elif len(spd) != len(dpd):
                report[name] = f"ROWS spark={len(spd)} duck={len(dpd)}"
            else:
                a, b = canon(spd), canon(dpd)
                bad = [(x, y) for x, y in zip(a, b) if x != y]
                report[name] = "OK" if not bad else f"VALUES {len(bad)} differ, e.g. {bad[:2]}"
            report[name] += f" rows={len(spd)}"
        if verbose:
            print(f"{name}: {report[name]} ({dt:.1f}s)", flush=True)
    return report


if __name__ == "__main__":
    from terrapanel.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    rep = compare(spark, sf, names)
    bad = {k: v for k, v in rep.items() if not (v.startswith("OK") or "no oracle" in v)}
    print(f"{len(rep) - len(bad)}/{len(rep)} fine")
    for k, v in bad.items():
        print("  FAIL", k, v)
