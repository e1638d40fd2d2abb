"""Queries of the training, forecasting, scoring and serving steps.

Series are ``user_id`` (150 at sf0.01, 1500 at sf0.1): the reference's real
workload is a few hundred series of a few thousand hourly points each.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import functions as F

from ratecast.functions import ieee_divide, nan_to_null
from ratecast.operators import arima as A
from ratecast.operators import changepoint as C
from ratecast.operators import evaluate as E
from ratecast.operators import forecast as M
from ratecast.operators import gridding as G
from ratecast.operators import local as L
from ratecast.operators import serve as SV
from ratecast.operators import training as TR
from ratecast.plans import arima_sql as AS
from ratecast.plans import changepoint_sql as CP
from ratecast.plans import local_sql as LS
from ratecast.plans import sql as S
from ratecast.plans.registry import register
from ratecast.sources.fixtures import read_ticks, ticks_from_events
from ratecast.sources.sinks import json_chunks, materialize, records_of_chunks, sink_bucketed, sink_json_records, sink_replace, table_dir
from ratecast.session import co_partitioned, co_partitioned_session
from ratecast.sources.tables import read_table

T5 = "symbol, tumble, date_str, intrp, unfilled, count"
BASE = S.model_base("user_id")
SEAS = [S.seasonal_ctes(), S.forecast_cte()]
AR = [S.ar1_ctes(), S.explain_cte()]

# Fixed serving arguments used by the registered serving queries.
AS_OF = "2024-02-15"                 # default end = as_of - 18 days = 2024-01-28
SERVE_START = "2024-01-20 00:00:00 UTC"
SERVE_END = "2024-01-28"
CURRENCIES = ["7", "42", "99"]


#: Columns that registered queries round to 6 decimals, as their oracles do; operators never round.
BANDS = ("yhat", "yhat_lower", "yhat_upper")
EXPLAINED = ("time_series_data", "prediction_interval_lower_bound", "prediction_interval_upper_bound")
XF = (f"symbol, time_series_timestamp, CASE WHEN {EXPLAINED[1]} IS NULL THEN time_series_data ELSE round(time_series_data, 6) END "
      f"AS time_series_data, {S.rounded(*EXPLAINED[1:])}")
FVA = f"symbol, ds, date_str, y, {S.rounded(*BANDS)}, intrp"
AVA = f"symbol, time_series_timestamp, date_str, y, {S.rounded(*BANDS)}, intrp"


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _rounded_explained(df):
    """Forecast rows rounded, history as it is."""
    data, lower, upper = EXPLAINED
    return _rounded(df.withColumn(data, F.when(F.col(lower).isNull(), F.col(data)).otherwise(F.round(data, 6))), lower, upper)


class _Stage:
    """The scheduled job's frames for one series key, plus the scalar bounds.

    The hourly aggregate is stored once (a checkpoint in the shared folder):
    the interpolation, its bounds and the cut all read it, and the ticks are
    scanned once. The interpolated table is recomputed from it where it is used.
    The holdout cut and the forecast end are scalar subqueries on that small
    table: ``max(T5.tumble)`` equals ``max(hourly.tumble)`` because the grid spans
    exactly the hourly bounds, and the last forecast time is the training end
    plus the horizon.
    """

    def __init__(self, spark, sf, symbol="user_id"):
        self.hourly = materialize(G.hourly_mean(read_ticks(spark, sf, symbol)))
        self.tasks = G.dense_tasks(self.hourly)
        self.t5 = G.interpolate_hourly(self.hourly, tasks=self.tasks)
        last = self.hourly.agg(F.max("tumble")).scalar()
        self.cut = last - F.expr(f"INTERVAL {TR.HOLDOUT_DAYS} DAYS")
        self.hi = self.cut + F.expr(f"INTERVAL {TR.HORIZON_HOURS} HOURS")
        cut_rows = TR.holdout_cut(self.t5, cut=self.cut)
        self.train = TR.series_min_length(TR.to_training_frame(cut_rows))
        # The AR models train on hours re-averaged over duplicate sources (A7, Q1); the seasonal one
        # does not. Deduping the guarded frame and guarding again keeps the same series as deduping
        # first (dedupe only removes rows), and shares the training subtree with the seasonal model.
        self.train_ar = TR.series_min_length(G.dedupe_hours(self.train, value="y", ts="ds"))


def _stored_train(spark, sf, average=False):
    """(training frame, its number of tasks), stored in buckets of ``symbol``: all that fits it by series reads it as it is dealt. ``average``: the AR models' frame."""
    st = _Stage(spark, sf)
    train = st.train_ar if average else st.train
    return sink_bucketed(train, table_dir(spark, "train", fresh=True), "symbol", ["symbol", "ds"], st.tasks), st.tasks


class _Frames(Mapping):
    """Model -> scored table, as serving takes them; a table is written when a request first reads it."""

    def __init__(self, tables):
        self.tables = tables

    def __getitem__(self, model):
        return {"PROPHET": lambda: self.tables.scored_seasonal, "ARIMA": lambda: self.tables.scored_ar}[model]()

    def __iter__(self):
        return iter(SERVED)

    def __len__(self):
        return len(SERVED)


class _Tables:
    """The scheduled job's tables, each written once per application and input when it is first asked for, and then only read.

    T5 (interpolated), T8 (seasonal forecast), T10 (model parameters), T11
    (explained AR forecast) and the scored tables that serving reads. All are dealt on ``symbol`` over ``tasks`` and
    sorted in their files, so a request for a few symbols and a time range reads few row groups. T5, T8 and T11 are bucketed: the models and
    the scoring read them as they are dealt, so the rows of the dense table are never shuffled.
    """

    written: dict[tuple[str, str], _Tables] = {}

    def __init__(self, spark, sf):
        self.spark, self.stage = spark, _Stage(spark, sf)
        self.hi, self.tasks, self.names = self.stage.hi, self.stage.tasks, {}

    def _bucketed(self, df, name, ts):
        path = table_dir(self.spark, name, fresh=True)
        known = path.rsplit("/", 1)[1].replace("-", "_")
        table = sink_bucketed(df, path, "symbol", ["symbol", ts], self.tasks, known)
        self.names[id(table)] = known
        return table

    def in_buckets(self, *tables):
        """Bucketed tables as frames whose joins by (symbol, time) stay within the buckets, whatever the session's settings."""
        spark = co_partitioned_session(self.spark)
        return [spark.table(self.names[id(table)]) for table in tables]

    def write(self, df, name, ts):
        with co_partitioned(self.spark):
            return sink_replace(df, table_dir(self.spark, name, fresh=True), cluster_by="symbol", sort_within=["symbol", ts], tasks=self.tasks)

    @cached_property
    def t5(self):
        return self._bucketed(self.stage.t5, "batch_hour_interpo", "tumble")

    @cached_property
    def train(self):
        return TR.series_min_length(TR.to_training_frame(TR.holdout_cut(self.t5, cut=self.stage.cut)))

    @cached_property
    def train_ar(self):
        return TR.series_min_length(G.dedupe_hours(self.train, value="y", ts="ds"))

    @cached_property
    def forecast(self):
        return self._bucketed(M.forecast_seasonal(self.train, tasks=self.tasks), "forecast_seasonal", "ds")

    @cached_property
    def params(self):
        return self.write(M.ar1_params(self.train_ar, self.tasks), "ar1_model", "ds_last")

    @cached_property
    def explained(self):
        return self._bucketed(M.explain_forecast(self.params, self.train_ar, tasks=self.tasks), "forecast_ar", "time_series_timestamp")

    @cached_property
    def scored_seasonal(self):
        return self.write(E.forecast_vs_actual(self.forecast, self.t5, hi=self.hi), "scored_seasonal", "ds")

    @cached_property
    def scored_ar(self):
        return self.write(E.arima_vs_actual(self.explained, self.t5, hi=self.hi), "scored_ar", "time_series_timestamp")

    @cached_property
    def split(self):
        return self.write(E.forecast_vs_actual_split(self.forecast, self.t5, hi=self.hi), "scored_split", "ds")

    @cached_property
    def frames(self):
        return _Frames(self)


def _tables(spark, sf) -> _Tables:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _Tables.written:
        _Tables.written[key] = _Tables(spark, sf)
    return _Tables.written[key]


def _t5(spark, sf, symbol="user_id"):
    return _Stage(spark, sf, symbol).t5


def _train(t5):
    return TR.series_min_length(TR.to_training_frame(TR.holdout_cut(t5)))


def _seasonal(spark, sf):
    st = _Stage(spark, sf)
    return st, M.forecast_seasonal(st.train, tasks=st.tasks)


def _ar(spark, sf):
    st = _Stage(spark, sf)
    return st, M.forecast_ar1(st.train_ar, tasks=st.tasks)


@register("holdout_cut", S.with_(*BASE) + f"SELECT {T5} FROM interp WHERE tumble <= (SELECT c FROM train_cut)")
def q_holdout_cut(spark, sf):
    st = _Stage(spark, sf)
    return TR.holdout_cut(st.t5, cut=st.cut)


@register("scan_training", S.with_(*BASE) + f"SELECT {T5} FROM interp WHERE tumble <= (SELECT c FROM train_cut)")
def q_scan_training(spark, sf):
    """Reads the interpolated table as written by the scheduled job, cut at max - 5 days (S3)."""
    t5 = sink_replace(_t5(spark, sf), table_dir(spark, "batch_hour_interpo", fresh=True))
    return TR.holdout_cut(t5)


@register("scan_symbol_ordered",
          S.with_(S.ticks_cte(), S.hourly_cte(), S.interp_ctes()) +
          f"SELECT {T5} FROM interp WHERE symbol = 'click' ORDER BY tumble")
def q_scan_symbol_ordered(spark, sf):
    t5 = _t5(spark, sf, "event_type")
    return t5.filter(F.col("symbol") == "click").orderBy("tumble")


@register("to_training_frame", S.with_(*BASE) + "SELECT * FROM train")
def q_to_training_frame(spark, sf):
    return _Stage(spark, sf).train


@register("series_min_length",
          S.with_(S.ticks_cte("user_id * 40 + event_id % 40"), S.hourly_cte()) +
          "SELECT symbol, tumble, mean, count FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM hourly) "
          "WHERE n >= 3")
def q_series_min_length(spark, sf):
    """Many short series over the whole table: most have fewer hours than the guard asks for."""
    ev = read_table(spark, sf, "events", ["ts", "event_id", "user_id", "value"]).withColumn("series", F.col("user_id") * 40 + F.col("event_id") % 40)
    return TR.series_min_length(G.hourly_mean(ticks_from_events(ev, "series")))


@register("collect_series",
          S.with_(S.ticks_cte(), S.hourly_cte(), S.interp_ctes(), S.train_ctes()) +
          "SELECT symbol, list({'ds': ds, 'y': y} ORDER BY ds, y) AS data FROM train GROUP BY symbol")
def q_collect_series(spark, sf):
    return TR.collect_series(_train(_t5(spark, sf, "event_type")))


@register("forecast_horizon",
          S.with_(*BASE, S.future_cte()) +
          "SELECT symbol, ds, false AS is_future FROM train UNION ALL SELECT symbol, ds, true FROM fut")
def q_forecast_horizon(spark, sf):
    st = _Stage(spark, sf)
    return TR.forecast_horizon(st.train, tasks=st.tasks)


@register("attach_history",
          S.with_(*BASE, S.future_cte()) +
          "SELECT h.symbol, h.ds, t.y FROM (SELECT symbol, ds FROM train UNION ALL SELECT symbol, ds FROM fut) h "
          "LEFT JOIN train t ON t.symbol = h.symbol AND t.ds = h.ds")
def q_attach_history(spark, sf):
    """Horizon rows merged with the training values on (symbol, ds), never by position."""
    st = _Stage(spark, sf)
    tr = st.train
    h = TR.forecast_horizon(tr, tasks=st.tasks).select("symbol", "ds")
    return h.join(tr.hint("merge"), ["symbol", "ds"], "left").select("symbol", "ds", "y")


@register("infer_frequency",
          S.with_(S.ticks_cte("user_id"), S.hourly_cte()) +
          f"SELECT symbol, -(max({{'n': n_gaps, 'g': -gap}})).g AS freq_seconds, max({{'n': n_gaps, 'g': -gap}}).n AS n_gaps "
          f"FROM (SELECT symbol, gap, count(*) AS n_gaps FROM (SELECT symbol, {S.epoch_s('tumble')} - "
          f"lag({S.epoch_s('tumble')}) OVER (PARTITION BY symbol ORDER BY tumble) AS gap FROM hourly) "
          f"WHERE gap IS NOT NULL GROUP BY symbol, gap) GROUP BY symbol")
def q_infer_frequency(spark, sf):
    return TR.infer_frequency(G.hourly_mean(read_ticks(spark, sf, "user_id")))


@register("nan_to_null",
          f"SELECT event_id, CASE WHEN isnan(q0) THEN NULL ELSE q0 END AS q0 FROM "
          f"(SELECT event_id, {S.ieee_div('floor(value) - floor(value)', 'event_id % 3')} AS q0 FROM events)")
def q_nan_to_null(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "value"])
    q0 = ieee_divide(F.floor("value") - F.floor("value"), F.col("event_id") % 3)
    return ev.select("event_id", nan_to_null(q0).alias("q0"))


@register("forecast_seasonal", S.with_(*BASE, *SEAS) + f"SELECT symbol, ds, y, {S.rounded(*BANDS)} FROM fc")
def q_forecast_seasonal(spark, sf):
    return _rounded(_seasonal(spark, sf)[1], *BANDS)


@register("decompose",
          S.with_(*BASE, S.seasonal_ctes(periods=0)) +
          "SELECT symbol, ds, y, round(trend, 6) AS trend, round(i_h * i_d, 6) AS seasonal, "
          "round(y - fitted, 6) AS remainder FROM seas WHERE y IS NOT NULL")
def q_decompose(spark, sf):
    st = _Stage(spark, sf)
    return _rounded(M.decompose(st.train, st.tasks), "trend", "seasonal", "remainder")


@register("forecast_ar1", S.with_(*BASE, *AR) + f"SELECT {XF} FROM xf")
def q_forecast_ar1(spark, sf):
    return _rounded_explained(_ar(spark, sf)[1])


@register("explain_forecast", S.with_(*BASE, *AR) + f"SELECT {XF} FROM xf")
def q_explain_forecast(spark, sf):
    """The same relation from the stored parameter table."""
    return _rounded_explained(_tables(spark, sf).explained)


@register("model_table",
          S.with_(*BASE, S.ar1_ctes()) +
          "SELECT symbol, n, y_last, ds_last, round(phi, 6) AS phi, round(c, 6) AS c, round(mu, 6) AS mu, "
          "round(sigma2, 6) AS sigma2, stationary FROM ar_params")
def q_model_table(spark, sf):
    """Per-series AR(1) parameters written as a table, replaced on each run (K5)."""
    st = _Stage(spark, sf)
    p = M.ar1_params(st.train_ar, st.tasks)
    t = sink_replace(p, table_dir(spark, "ar1_model", fresh=True))
    return t.select("symbol", "n", "y_last", "ds_last", *[F.round(c, 6).alias(c) for c in ("phi", "c", "mu", "sigma2")],
                    "stationary")


@register("forecast_window_filter",
          S.with_(*BASE, *SEAS) +
          f"SELECT {T5} FROM interp WHERE tumble > (SELECT max(ds) - INTERVAL 5 DAY FROM fc) "
          "AND tumble <= (SELECT max(ds) FROM fc)")
def q_forecast_window_filter(spark, sf):
    st, fc = _seasonal(spark, sf)
    return E.forecast_window_filter(st.t5, fc, hi=st.hi)


@register("forecast_vs_actual", S.with_(*BASE, *SEAS, S.fva_cte()) + f"SELECT {FVA} FROM fva")
def q_forecast_vs_actual(spark, sf):
    st, fc = _seasonal(spark, sf)
    return _rounded(E.forecast_vs_actual(fc, st.t5, hi=st.hi), *BANDS)


@register("forecast_vs_actual_split",
          S.with_(*BASE, *SEAS) +
          f"SELECT s.symbol, s.ds, {S.date_str('s.ds')} AS date_str, round(s.yhat, 6) AS yhat, "
          "round(s.yhat_lower, 6) AS yhat_lower, round(s.yhat_upper, 6) AS yhat_upper, "
          "CASE WHEN b.tumble <= (SELECT max(ds) - INTERVAL 5 DAY FROM fc) THEN b.intrp END AS y, "
          "CASE WHEN b.tumble > (SELECT max(ds) - INTERVAL 5 DAY FROM fc) THEN b.intrp END AS intrp "
          "FROM fc s LEFT JOIN (SELECT * FROM interp WHERE tumble <= (SELECT max(ds) FROM fc)) b "
          "ON b.tumble = s.ds AND s.symbol = b.symbol")
def q_forecast_vs_actual_split(spark, sf):
    st, fc = _seasonal(spark, sf)
    return _rounded(E.forecast_vs_actual_split(fc, st.t5, hi=st.hi), *BANDS)


@register("arima_vs_actual", S.with_(*BASE, *AR, S.ava_cte()) +
          f"SELECT {AVA} FROM ava")
def q_arima_vs_actual(spark, sf):
    st, xf = _ar(spark, sf)
    return _rounded(E.arima_vs_actual(xf, st.t5, hi=st.hi).drop("time_series_data"), *BANDS)


@register("split_actual_holdout",
          S.with_(*BASE) +
          "SELECT symbol, tumble, CASE WHEN tumble <= (SELECT c FROM train_cut) THEN intrp END AS y, "
          "CASE WHEN tumble > (SELECT c FROM train_cut) THEN intrp END AS holdout FROM interp")
def q_split_actual_holdout(spark, sf):
    st = _Stage(spark, sf)
    return TR.split_actual_holdout(st.t5, cut=st.cut)


def _rmse_sql(src: str, ts: str, model: str, by_symbol: bool) -> str:
    g = "symbol, " if by_symbol else ""
    r = lambda b: f"round(sqrt(avg(pow(intrp - {b}, 2))), 6)"
    return (f"SELECT {g}'{model}' AS model, {r('yhat')} AS rmse, {r('yhat_upper')} AS rmse_upper, "
            f"{r('yhat_lower')} AS rmse_lower, count(intrp) AS n FROM {src} "
            f"WHERE {ts} > (SELECT max({ts}) - INTERVAL 5 DAY FROM {src})" + (" GROUP BY symbol" if by_symbol else ""))


RMSE = ("rmse", "rmse_upper", "rmse_lower")


def _rmse_spark(spark, sf, by_symbol):
    t = _tables(spark, sf)
    a = E.forecast_rmse(t.scored_seasonal, "ds", by_symbol, hi=t.hi).withColumn("model", F.lit("PROPHET"))
    b = E.forecast_rmse(t.scored_ar, "time_series_timestamp", by_symbol, hi=t.hi).withColumn("model", F.lit("ARIMA"))
    return _rounded(a.unionByName(b), *RMSE)


@register("forecast_rmse",
          S.with_(*BASE, *SEAS, *AR, S.fva_cte(), S.ava_cte()) +
          _rmse_sql("fva", "ds", "PROPHET", False) + " UNION ALL " +
          _rmse_sql("ava", "time_series_timestamp", "ARIMA", False))
def q_forecast_rmse(spark, sf):
    return _rmse_spark(spark, sf, False)


@register("forecast_report",
          S.with_(*BASE, *SEAS, *AR, S.fva_cte(), S.ava_cte()) +
          _rmse_sql("fva", "ds", "PROPHET", True) + " UNION ALL " +
          _rmse_sql("ava", "time_series_timestamp", "ARIMA", True))
def q_forecast_report(spark, sf):
    """Holdout cut -> both models -> join with actuals -> RMSE per symbol and model."""
    return _rmse_spark(spark, sf, True)


SPLIT_CTE = (f"split AS (SELECT s.symbol, s.ds, s.yhat, s.yhat_lower, s.yhat_upper, "
             "CASE WHEN b.tumble <= (SELECT max(ds) - INTERVAL 5 DAY FROM fc) THEN b.intrp END AS y, "
             "CASE WHEN b.tumble > (SELECT max(ds) - INTERVAL 5 DAY FROM fc) THEN b.intrp END AS intrp "
             "FROM fc s LEFT JOIN (SELECT * FROM interp WHERE tumble <= (SELECT max(ds) FROM fc)) b "
             "ON b.tumble = s.ds AND s.symbol = b.symbol)")


@register("forecast_rmse_split", S.with_(*BASE, *SEAS, SPLIT_CTE) + _rmse_sql("split", "ds", "PROPHET", False))
def q_forecast_rmse_split(spark, sf):
    """The same score over the split join."""
    t = _tables(spark, sf)
    return _rounded(E.forecast_rmse(t.split, "ds", hi=t.hi).withColumn("model", F.lit("PROPHET")), *RMSE)


DASHBOARD = ("y", *BANDS, "intrp")


def _dashboard_sql(src: str, ts: str) -> str:
    means = ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in DASHBOARD)
    return f"SELECT {S.tumble(ts, 3600)} AS date_hour, {means} FROM {src} GROUP BY 1"


def _dashboard(scored, ts="ds"):
    return _rounded(E.dashboard_hourly(scored, ts), *[f"avg_{c}" for c in DASHBOARD])


@register("dashboard_hourly", S.with_(*BASE, *SEAS, S.fva_cte()) + _dashboard_sql("fva", "ds"))
def q_dashboard_hourly(spark, sf):
    return _dashboard(_tables(spark, sf).scored_seasonal)


@register("dashboard_hourly_split", S.with_(*BASE, *SEAS, SPLIT_CTE) + _dashboard_sql("split", "ds"))
def q_dashboard_hourly_split(spark, sf):
    return _dashboard(_tables(spark, sf).split)


@register("dashboard_hourly_arima", S.with_(*BASE, *AR, S.ava_cte()) + _dashboard_sql("ava", "time_series_timestamp"))
def q_dashboard_hourly_arima(spark, sf):
    return _dashboard(_tables(spark, sf).scored_ar, "time_series_timestamp")


@register("symbol_list", S.with_(S.ticks_cte("user_id"), S.hourly_cte()) + "SELECT DISTINCT symbol FROM hourly ORDER BY symbol")
def q_symbol_list(spark, sf):
    """From the hourly table: the grid adds hours, never symbols (A10)."""
    return TR.symbol_list(G.hourly_mean(read_ticks(spark, sf, "user_id")))


@register("datestr_range",
          S.with_(*BASE, *SEAS, S.fva_cte()) + f"SELECT {FVA} FROM fva WHERE CAST(date_str AS BIGINT) >= 20240125000000")
def q_datestr_range(spark, sf):
    return _rounded(TR.datestr_range(_tables(spark, sf).scored_seasonal, 20240125000000), *BANDS)


def _serve_where(ts: str, currencies) -> str:
    w = f"{ts} BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '{SERVE_END}'"
    if currencies:
        w = "symbol IN (" + ", ".join(f"'{c}'" for c in currencies) + f") AND {w}"
    return w


#: model -> CTEs, scored CTE, its time, the value of its statistics, columns of its detail, those that are rounded
SERVED = {
    "PROPHET": ((*SEAS, S.fva_cte()), "fva", "ds", "y", FVA, BANDS),
    "ARIMA": ((*AR, S.ava_cte()), "ava", "time_series_timestamp", "time_series_data", AVA, BANDS),
}


def _detail(spark, sf, model, currencies):
    d = SV.serve_detail(_tables(spark, sf).frames, model, currencies, SERVE_START, SV.default_end(AS_OF))
    return _rounded(d, *SERVED[model][5])


def _detail_sql(model, currencies) -> str:
    ctes, src, ts, _, cols, _ = SERVED[model]
    return S.with_(*BASE, *ctes) + f"SELECT {cols} FROM {src} WHERE {_serve_where(ts, currencies)}"


def _register_served(model, currencies, name) -> None:
    ctes, src, ts, value, _, _ = SERVED[model]
    register(f"serve_detail{name}", _detail_sql(model, currencies))(
        lambda spark, sf: _detail(spark, sf, model, currencies))
    for stat in SV.STATS:
        sql = (S.with_(*BASE, *ctes) + f"SELECT symbol, round({stat}({value}), 6) AS \"{stat}\" FROM {src} "
               f"WHERE {_serve_where(ts, currencies)} GROUP BY symbol ORDER BY symbol")
        register(f"serve_{stat.lower()}{name}", sql)(lambda spark, sf, stat=stat: _rounded(SV.serve_stat(
            _tables(spark, sf).frames, stat, model, currencies, SERVE_START, SV.default_end(AS_OF)), stat))


# all forms of a request: 2 models x (detail, 3 statistics) x (some currencies, all)
for _model, _currencies, _name in (("PROPHET", CURRENCIES, ""), ("PROPHET", None, "_all"),
                                   ("ARIMA", CURRENCIES, "_arima_some"), ("ARIMA", None, "_arima")):
    _register_served(_model, _currencies, _name)


@register("serve_stat",
          S.with_(*BASE, *SEAS, S.fva_cte()) +
          f"SELECT symbol, round(avg(y), 6) AS \"AVG\" FROM fva WHERE {_serve_where('ds', CURRENCIES)} GROUP BY symbol ORDER BY symbol")
def q_serve_stat(spark, sf):
    return _rounded(SV.serve_stat(_tables(spark, sf).frames, "AVG", "PROPHET", CURRENCIES, SERVE_START, SV.default_end(AS_OF)), "AVG")


@register("serve_stat_arima",
          S.with_(*BASE, *AR, S.ava_cte()) +
          f"SELECT symbol, round(max(time_series_data), 6) AS \"MAX\" FROM ava WHERE {_serve_where('time_series_timestamp', None)} "
          "GROUP BY symbol ORDER BY symbol")
def q_serve_stat_arima(spark, sf):
    return _rounded(SV.serve_stat(_tables(spark, sf).frames, "MAX", "ARIMA", None, SERVE_START, SV.default_end(AS_OF)), "MAX")


@register("serve_stat_one_currency",
          S.with_(*BASE, *SEAS, S.fva_cte()) +
          f"SELECT symbol, min(y) AS \"MIN\" FROM fva WHERE {_serve_where('ds', ['42'])} GROUP BY symbol ORDER BY symbol")
def q_serve_stat_one_currency(spark, sf):
    """One currency: a one-element list, no trailing-comma tuple text (Q4)."""
    return SV.serve_stat(_tables(spark, sf).frames, "MIN", "PROPHET", ["42"], SERVE_START, SV.default_end(AS_OF))


@register("sink_json_records", _detail_sql("PROPHET", CURRENCIES))
def q_sink_json_records(spark, sf):
    """Detail rows written as JSON records and parsed back (K4)."""
    d = _detail(spark, sf, "PROPHET", CURRENCIES)
    return sink_json_records(d, table_dir(spark, "serve_detail_json", fresh=True))


@register("forecast_ar_auto")
def q_forecast_ar_auto(spark, sf):
    """Automatic order (p <= 5, d <= 2) per series; Python per group, so rows-only check (M5)."""
    from ratecast.operators.ar_auto import forecast_ar_auto
    return forecast_ar_auto(_Stage(spark, sf).train_ar)


# --- trend breaks, smooth seasonality, widening band (M1) ---

COMPONENTS = ("yhat", "trend", "seasonal")


@register("forecast_changepoint",
          S.with_(*BASE, *CP.fit_ctes(), S.future_cte(), CP.scored_cte("(SELECT * FROM train UNION ALL SELECT * FROM fut)")) +
          "SELECT symbol, ds, y, round(trend * (1 + seasonal), 3) AS yhat, round(trend, 3) AS trend, round(seasonal, 3) AS seasonal FROM cp_scored")
def q_forecast_changepoint(spark, sf):
    """Point forecast and its parts; three decimals, as the fit solves systems whose last bits follow the order of sums."""
    train, _ = _stored_train(spark, sf)
    parts = C.components(train, C.fit_changepoints(train))
    return parts.select("symbol", "ds", "y", *[F.round(c, 3).alias(c) for c in COMPONENTS])


@register("changepoint_model",
          S.with_(*BASE, *CP.fit_ctes()) +
          "SELECT symbol, ymax, round(slope[1], 4) AS first_slope, round(slope[-1], 4) AS last_slope, round(icpt[1], 4) AS icpt, "
          "list_transform(delta, lambda x: round(x, 4) + 0.0) AS delta, list_transform(beta, lambda x: round(x, 4) + 0.0) AS beta, round(sigma2, 6) AS sigma2 FROM cp_fit")
def q_changepoint_model(spark, sf):
    """Parameters of every series: breaks, seasonal coefficients, residual variance (scaled units)."""
    p = C.fit_changepoints(_stored_train(spark, sf)[0])
    short = lambda c: F.transform(c, lambda x: F.round(x, 4) + F.lit(0.0)).alias(c)
    return p.select("symbol", "ymax", F.round(F.get("slope", F.lit(0)), 4).alias("first_slope"), F.round(F.element_at("slope", -1), 4).alias("last_slope"),
                    F.round(F.get("icpt", F.lit(0)), 4).alias("icpt"), short("delta"), short("beta"), F.round("sigma2", 6).alias("sigma2"))


@register("forecast_changepoint_band")
def q_forecast_changepoint_band(spark, sf):
    """The forecast table with its simulated band (T8); draws are hashes, which SQL cannot repeat."""
    return C.forecast_changepoint(_stored_train(spark, sf)[0])


# --- ARIMA with moving-average terms (M5) ---

BY_TYPE = S.model_base("event_type")


@register("kpss", S.with_(*BY_TYPE, *AS.kpss_ctes()) + "SELECT symbol, d, n, round(kpss, 5) AS kpss FROM kpss")
def q_kpss(spark, sf):
    """KPSS statistic of every series and its differences, which decides how often it is differenced."""
    return A.kpss_statistics(_Stage(spark, sf, "event_type").train_ar).withColumn("kpss", F.round("kpss", 5))


@register("hannan_rissanen", S.with_(*BY_TYPE, *AS.hannan_rissanen_ctes(2, 1)) +
          "SELECT symbol, round(const, 3) AS const, list_transform(phi, lambda x: round(x, 3)) AS phi, list_transform(theta, lambda x: round(x, 3)) AS theta, round(sigma2, 3) AS sigma2, n FROM hr")
def q_hannan_rissanen(spark, sf):
    """ARMA(2, 1) of every series by two least-squares stages on sums that Spark aggregates."""
    hr = A.hannan_rissanen(A.difference(_Stage(spark, sf, "event_type").train_ar), 2, 1)
    short = lambda c: F.transform(c, lambda x: F.round(x, 3)).alias(c)
    return hr.select("symbol", F.round("const", 3).alias("const"), short("phi"), short("theta"), F.round("sigma2", 3).alias("sigma2"), "n")


@register("arima_model")
def q_arima_model(spark, sf):
    """Orders, coefficients and variance of every series (T10); refinement follows each series, so no SQL."""
    train, tasks = _stored_train(spark, sf, average=True)
    return A.arima_model(train, tasks)


@register("forecast_arima")
def q_forecast_arima(spark, sf):
    """Explain-forecast relation of the automatic ARIMA."""
    train, tasks = _stored_train(spark, sf, average=True)
    return A.forecast_arima(train, tasks=tasks)


# --- local decomposition (M6) ---

LOCAL = ("trend", "seasonal", "remainder", "weight")


@register("decompose_local", S.with_(*BASE, *LS.ctes()) + "SELECT symbol, ds, y, " + ", ".join(f"round({c}, 3) + 0.0 AS {c}" for c in LOCAL) + " FROM ld")
def q_decompose_local(spark, sf):
    """Trend, seasonal part and remainder by local regression with robustness weights."""
    st = _Stage(spark, sf)
    d = L.decompose_local(st.train, tasks=st.tasks)
    return d.select("symbol", "ds", "y", *[(F.round(c, 3) + F.lit(0.0)).alias(c) for c in LOCAL])


@register("json_chunks", _detail_sql("PROPHET", None))
def q_json_chunks(spark, sf):
    """All detail rows as one JSON document in bounded chunks (here 64 KiB, so that there are many), written, read and parsed back (K4)."""
    d = _detail(spark, sf, "PROPHET", None)
    chunks = sink_replace(json_chunks(d, ["symbol", "ds"], 2 ** 16), table_dir(spark, "serve_detail_chunks", fresh=True))
    return records_of_chunks(chunks, d.schema)


# --- joins without an exchange over bucketed tables (O2, J4, J6) ---


@register("forecast_vs_actual_bucketed", S.with_(*BASE, *SEAS, S.fva_cte()) + f"SELECT {FVA} FROM fva")
def q_forecast_vs_actual_bucketed(spark, sf):
    """The forecast table joined with the actuals where both are bucketed by symbol."""
    t = _tables(spark, sf)
    forecast, actual = t.in_buckets(t.forecast, t.t5)
    return _rounded(E.forecast_vs_actual(forecast, actual, hi=t.hi), *BANDS)


@register("forecast_rmse_bucketed", S.with_(*BASE, *AR, S.ava_cte()) + _rmse_sql("ava", "time_series_timestamp", "ARIMA", True))
def q_forecast_rmse_bucketed(spark, sf):
    """The AR forecast joined with the actuals and scored per symbol, all within the buckets."""
    t = _tables(spark, sf)
    explained, actual = t.in_buckets(t.explained, t.t5)
    scored = E.arima_vs_actual(explained, actual, hi=t.hi)
    return _rounded(E.forecast_rmse(scored, "time_series_timestamp", True, hi=t.hi).withColumn("model", F.lit("ARIMA")), *RMSE)
