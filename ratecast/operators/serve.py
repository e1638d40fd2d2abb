"""Parameterised detail and statistic queries over the scored forecasts (API).

The reference picks one of eight SQL templates and formats arguments into
SQL text; here one composition takes them as values: choose the model frame,
filter by currency list and closed time range, optionally aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the serving arguments.
MODELS = ("ARIMA", "PROPHET")
STATS = ("MAX", "MIN", "AVG")
DEFAULT_MODEL = "PROPHET"
DEFAULT_START = "2020-11-11 08:00:00 UTC"
DEFAULT_END_LAG_DAYS = 18   # default end = as_of - 18 days

_TIME = {"PROPHET": "ds", "ARIMA": "time_series_timestamp"}
_VALUE = {"PROPHET": "y", "ARIMA": "time_series_data"}
DETAIL_COLUMNS = {
    "PROPHET": ["symbol", "ds", "date_str", "y", "yhat", "yhat_lower", "yhat_upper", "intrp"],
    "ARIMA": ["symbol", "time_series_timestamp", "date_str", "y", "yhat", "yhat_lower", "yhat_upper", "intrp"],
}


def _ts(v) -> F.Column:
    if isinstance(v, dt.datetime):
        v = v.isoformat(sep=" ")
    elif isinstance(v, dt.date):
        v = v.isoformat()
    v = str(v).strip()
    if v.endswith(" UTC"):
        v = v[:-4]
    return F.lit(v).cast("timestamp_ntz")


def default_end(as_of) -> dt.date:
    """``as_of - 18 days``: the reference's default end, with the date passed in."""
    return dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=DEFAULT_END_LAG_DAYS)


def check_args(model: str, stat: str | None) -> None:
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; choose one of {MODELS}")
    if stat is not None and stat not in STATS:
        raise ValueError(f"unknown stat {stat!r}; choose one of {STATS}")


def _filtered(frames: dict[str, DataFrame], model: str, currencies, start, end) -> DataFrame:
    df = frames[model]
    t = _TIME[model]
    if currencies is not None:
        df = df.filter(F.col("symbol").isin(list(currencies)))   # a list, never SQL text (Q4)
    return df.filter(F.col(t).between(_ts(start), _ts(end)))      # closed range (Q12)


def serve_detail(frames: dict[str, DataFrame], model: str = DEFAULT_MODEL, currencies=None,
                 start=DEFAULT_START, end=None) -> DataFrame:
    """Detail rows of one model (P5, P6): ``frames`` maps model name to its
    scored frame (``forecast_vs_actual`` / ``arima_vs_actual`` output)."""
    check_args(model, None)
    if end is None:
        raise ValueError("end is required (the reference derives it from today's date; pass as_of - 18 days)")
    return _filtered(frames, model, currencies, start, end).select(*DETAIL_COLUMNS[model])


def serve_stat(frames: dict[str, DataFrame], stat: str, model: str = DEFAULT_MODEL, currencies=None,
               start=DEFAULT_START, end=None) -> DataFrame:
    """``MAX|MIN|AVG`` of the model's value column per symbol, ordered by symbol.

    The ARIMA frame keeps the explain-forecast value, which holds both history
    and forecast values.
    """
    check_args(model, stat)
    if end is None:
        raise ValueError("end is required (pass as_of - 18 days)")
    df = _filtered(frames, model, currencies, start, end)
    fn = {"MAX": F.max, "MIN": F.min, "AVG": F.avg}[stat]
    return df.groupBy("symbol").agg(fn(F.col(_VALUE[model])).alias(stat)).orderBy("symbol")
