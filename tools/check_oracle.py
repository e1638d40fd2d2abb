"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [name ...]

Columns are compared by name, rows order-insensitively; floats must match
exactly (NaN equals NaN). Prints one line per query and a summary.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            df[c] = s.dt.tz_localize(None).astype("datetime64[us]").astype("int64") if s.dt.tz is not None else s.astype("datetime64[us]").astype("int64")
        elif s.dtype == object:
            df[c] = s.map(lambda v: repr(_plain(v)))
    return df


def _plain(v):
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in v.items()}
    if hasattr(v, "asDict"):
        return {k: _plain(x) for k, x in v.asDict().items()}
    if isinstance(v, (list, tuple, np.ndarray)):
        return [_plain(x) for x in v]
    if isinstance(v, (pd.Timestamp, dt.datetime, dt.date)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, float) and np.isnan(v):
        return "nan"
    return v


def compare(a: pd.DataFrame, b: pd.DataFrame) -> str | None:
    if sorted(a.columns) != sorted(b.columns):
        return f"columns differ: {sorted(a.columns)} vs {sorted(b.columns)}"
    if len(a) != len(b):
        return f"rows differ: {len(a)} vs {len(b)}"
    a, b = _norm(a), _norm(b)
    cols = list(a.columns)
    a = a.sort_values(cols, na_position="first", kind="mergesort").reset_index(drop=True)
    b = b.sort_values(cols, na_position="first", kind="mergesort").reset_index(drop=True)
    for c in cols:
        x, y = a[c], b[c]
        if pd.api.types.is_float_dtype(x) or pd.api.types.is_float_dtype(y):
            xv, yv = x.astype("float64").to_numpy(), y.astype("float64").to_numpy()
            same = (xv == yv) | (np.isnan(xv) & np.isnan(yv))
            if not same.all():
                d = np.nanmax(np.abs(xv - yv)[~same]) if (~same).any() else 0
                return f"column {c}: {(~same).sum()} values differ (max abs diff {d:g})"
        else:
            xs, ys = x.astype(str).to_numpy(), y.astype(str).to_numpy()
            if not (xs == ys).all():
                i = int(np.argmax(xs != ys))
                return f"column {c}: {(xs != ys).sum()} values differ, e.g. {xs[i][:150]!r} vs {ys[i][:150]!r}"
    return None


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--partitions", type=int, default=8, help="spark.sql.shuffle.partitions")
    ap.add_argument("--tz", default="UTC", help="session time zone (results must not depend on it)")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from ratecast.plans import oracle_sql, queries
    from ratecast.session import local_session

    spark = local_session(8, args.partitions, extra={"spark.sql.session.timeZone": args.tz})
    con = duckdb.connect()
    for t in TABLES:
        p = f"{args.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sql = queries(), oracle_sql()
    names = args.names or list(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = qs[n](spark, args.sf)
            a = sdf.toPandas()
            if n not in sql:
                print(f"{n:32s} rows-only  {len(a):8d} rows  {time.time()-t0:6.1f}s")
                continue
            b = con.execute(sql[n]).fetchdf()
            err = compare(a, b)
        except Exception as e:  # noqa: BLE001
            err = f"ERROR {type(e).__name__}: {str(e)[:400]}"
            a = []
        bad += err is not None
        print(f"{n:32s} {'OK  ' if err is None else 'FAIL'} {len(a):8d} rows  {time.time()-t0:6.1f}s  {err or ''}")
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
