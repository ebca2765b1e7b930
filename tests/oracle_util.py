"""Spark-vs-DuckDB result comparison: row count, column names, and the
multiset of rows (order-insensitive), with doubles compared to 1e-9 relative."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duckdb_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    try:
        con.execute("SET TimeZone='UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        return pd.DataFrame(cur.fetchall(), columns=cols, dtype=object)
    finally:
        con.close()


def spark_frame(df) -> pd.DataFrame:
    rows = df.collect()
    return pd.DataFrame([tuple(r) for r in rows], columns=df.columns, dtype=object)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if v is pd.NaT:
        return None
    if isinstance(v, decimal.Decimal):
        return ("num", float(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, (int,)) or (hasattr(v, "dtype") and str(getattr(v, "dtype", "")).startswith("int")):
        return ("num", float(v))
    if isinstance(v, float):
        return ("num", v)
    if isinstance(v, pd.Timestamp):
        return ("ts", v.to_pydatetime().replace(tzinfo=None))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None))
    if isinstance(v, dt.date):
        return ("date", v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return ("s", str(v))


def _key(row):
    return tuple((x is None, repr(x if x is None else (x[0], round(x[1], 6)) if x[0] == "num" else x)) for x in row)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> tuple[bool, str]:
    gc, wc = sorted(got.columns), sorted(want.columns)
    if gc != wc:
        return False, f"columns differ: spark={list(got.columns)} oracle={list(want.columns)}"
    if len(got) != len(want):
        return False, f"row count spark={len(got)} oracle={len(want)}"
    g = sorted((tuple(_norm(v) for v in r) for r in got[gc].itertuples(index=False)), key=_key)
    w = sorted((tuple(_norm(v) for v in r) for r in want[wc].itertuples(index=False)), key=_key)
    exact = True
    for a, b in zip(g, w):
        for x, y in zip(a, b):
            if x == y:
                continue
            if x is not None and y is not None and x[0] == y[0] == "num":
                if math.isclose(x[1], y[1], rel_tol=1e-9, abs_tol=1e-9):
                    exact = False
                    continue
            return False, f"value differs: spark={a} oracle={b}"
    return True, f"{len(got)} rows match" + ("" if exact else " (doubles within 1e-9)")
