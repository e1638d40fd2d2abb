"""Time slices that stand in for a day's stream (replayed from a batch table)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ts(v) -> F.Column:
    if isinstance(v, (dt.datetime, dt.date)):
        v = v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    return F.lit(str(v)).cast("timestamp_ntz")


def replay_slice(df: DataFrame, start, end, ts: str = "timestamp") -> DataFrame:
    """Half-open slice ``start <= ts < end`` (S5). ``start``/``end`` are arguments,
    never the clock: the caller passes ``as_of - N days``."""
    return df.filter((F.col(ts) >= _ts(start)) & (F.col(ts) < _ts(end)))


def holdout_slice(df: DataFrame, as_of, from_days: int, to_days: int, ts: str = "timestamp") -> DataFrame:
    """Validation slice ``[as_of - from_days, as_of - to_days)``."""
    d = dt.date.fromisoformat(str(as_of)[:10])
    return replay_slice(df, d - dt.timedelta(days=from_days), d - dt.timedelta(days=to_days), ts)
