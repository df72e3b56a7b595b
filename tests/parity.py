"""Compare registered Spark queries with their DuckDB SQL on one scale factor.

Usage: ``python tests/parity.py [sf_dir] [name ...]``.  Also used by
``tests/test_parity.py``.  Columns are sorted by name, rows are sorted, and
values must be equal (floats exactly; the queries are written so both engines
produce the same bits).
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

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        v = v.item()
        return _norm(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or sorted(qs):
        t0 = time.time()
        entry = {"oracle": name in sqls}
        try:
            sdf = qs[name](spark, sf_dir)
            spd = sdf.toPandas()
            entry["rows"] = len(spd)
            entry["spark_sec"] = round(time.time() - t0, 2)
            if name in sqls:
                dpd = con.execute(sqls[name]).df()
                entry["oracle_rows"] = len(dpd)
                entry["cols_match"] = sorted(spd.columns) == sorted(dpd.columns)
                if entry["cols_match"]:
                    a, b = canon(spd), canon(dpd)
                    entry["values_match"] = a == b
                    if a != b:
                        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                        entry["first_diffs"] = diff
                    entry["dtypes"] = {
                        c: (str(spd[c].dtype), str(dpd[c].dtype))
                        for c in sorted(spd.columns)
                        if str(spd[c].dtype) != str(dpd[c].dtype)
                    }
                else:
                    entry["cols"] = (sorted(spd.columns), sorted(dpd.columns))
        except Exception as exc:  # report and continue with the next query
            entry["error"] = f"{type(exc).__name__}: {str(exc)[:400]}"
        report[name] = entry
        if verbose:
            print(name, entry, flush=True)
    return report


if __name__ == "__main__":
    from shiplens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    rep = compare(spark, sf, names)
    bad = [n for n, e in rep.items() if e.get("error") or (e["oracle"] and not e.get("values_match"))]
    print("FAILED:", bad)
    spark.stop()
