"""Compare registered queries with their DuckDB oracle (tests and scripts)."""

from __future__ import annotations

import time

import duckdb
import pandas as pd

from rivulet.plans.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "None"
    if hasattr(v, "item"):          # numpy scalars
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return str(v)


def normalize(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    out = pd.DataFrame({c: [_cell(v) for v in df[c].astype(object)] for c in df.columns})
    return out.sort_values(list(out.columns)).reset_index(drop=True) if len(out) else out


def compare_one(spark, con, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    res = {"rows": len(sdf), "sec": round(time.time() - t0, 2)}
    if sql is None:
        res["match"] = None
        return res
    odf = con.execute(sql).df()
    res["oracle_rows"] = len(odf)
    if sorted(sdf.columns) != sorted(odf.columns):
        res.update(match=False, spark_cols=sorted(sdf.columns), oracle_cols=sorted(odf.columns))
        return res
    if len(sdf) != len(odf):
        res["match"] = False
        return res
    a, b = normalize(sdf), normalize(odf)
    same = (a.values == b.values).all(axis=1) if len(a) else []
    res["match"] = bool(len(a) == 0 or same.all())
    if not res["match"]:
        res["first_diff"] = {"spark": a[~same].head(3).to_dict("records"),
                             "oracle": b[~same].head(3).to_dict("records")}
    return res
