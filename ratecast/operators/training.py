"""Model input: holdout cut, training frame, series guards, horizon, frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecast.functions import epoch_seconds

HOLDOUT_DAYS = 5      # fixed value: validation window kept out of training
HORIZON_HOURS = 120   # fixed value: forecast horizon (5 days of hours)


def max_minus(df: DataFrame, ts: str, days: int) -> Column:
    """``(SELECT max(ts) - INTERVAL days DAY FROM df)`` as a scalar subquery."""
    return df.agg(F.max(ts)).scalar() - F.expr(f"INTERVAL {int(days)} DAYS")


def holdout_cut(df: DataFrame, ts: str = "tumble", days: int = HOLDOUT_DAYS,
                cut: Column | None = None) -> DataFrame:
    """Rows with ``ts <= max(ts) - days`` (P7, M3); the cut is a runtime scalar subquery.

    ``cut`` may be given as a scalar Column computed from a smaller frame with
    the same maximum (the hourly table bounds the grid), so the subquery does
    not re-plan the whole upstream chain.
    """
    cut = max_minus(df, ts, days) if cut is None else cut
    return df.filter(F.col(ts) <= cut)


def split_actual_holdout(df: DataFrame, value: str = "intrp", ts: str = "tumble",
                         days: int = HOLDOUT_DAYS, cut: Column | None = None) -> DataFrame:
    """``IF(ts <= cut, v, NULL) AS y`` and ``IF(ts > cut, v, NULL) AS holdout``."""
    cut = max_minus(df, ts, days) if cut is None else cut
    return df.select("symbol", ts, F.when(F.col(ts) <= cut, F.col(value)).alias("y"),
                     F.when(F.col(ts) > cut, F.col(value)).alias("holdout"))


def to_training_frame(df: DataFrame, ts: str = "tumble", value: str = "intrp") -> DataFrame:
    """Project to ``(symbol, ds, y)`` (P2). Timestamps are already zone-free."""
    return df.select("symbol", F.col(ts).alias("ds"), F.col(value).alias("y"))


def series_min_length(df: DataFrame, min_rows: int = 3) -> DataFrame:
    """Keep series with at least ``min_rows`` rows ("more than 2", P11).

    A per-symbol count window: on a frame already clustered and sorted by
    symbol (as the interpolated table is) it adds neither exchange nor sort.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    return df.withColumn("_n", n).filter(F.col("_n") >= min_rows).drop("_n")


def collect_series(df: DataFrame) -> DataFrame:
    """``collect_list(struct(ds, y))`` per symbol, time-ordered (A5).

    The array of a symbol holds one element per grid bucket of that symbol,
    so its length is the time span over the bucket width, independent of how
    many ticks the symbol has.
    """
    return df.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("ds", "y"))).alias("data"))


def forecast_horizon(train: DataFrame, periods: int = HORIZON_HOURS, step_seconds: int = 3600,
                     tasks: int | None = None) -> DataFrame:
    """History times plus ``periods`` buckets after each symbol's last time (M2).

    Output ``(symbol, ds, is_future)``. The last row of each series is exploded
    into itself and the future buckets, so the frame is read once.
    """
    n = tasks or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = Window.partitionBy("symbol").orderBy(F.col("ds").asc(), F.col("y").asc_nulls_first())
    f = train.select("symbol", "ds", "y").repartition(n, "symbol")
    f = f.withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    steps = F.when(F.col("_last"), F.sequence(F.lit(0), F.lit(int(periods)))).otherwise(F.array(F.lit(0)))
    e = f.select("symbol", "ds", F.explode(steps).alias("_h"))
    return e.select("symbol",
                    F.timestamp_add("SECOND", F.col("_h").cast("long") * int(step_seconds), F.col("ds")).alias("ds"),
                    (F.col("_h") > 0).alias("is_future"))


def infer_frequency(df: DataFrame, ts: str = "tumble") -> DataFrame:
    """Most common gap between consecutive times of each symbol (M7).

    Ties go to the smaller gap. Output ``(symbol, freq_seconds, n_gaps)``.
    """
    w = Window.partitionBy("symbol").orderBy(ts)
    gaps = df.select("symbol", (epoch_seconds(ts) - epoch_seconds(F.lag(ts).over(w))).alias("gap")) \
        .filter(F.col("gap").isNotNull())
    counts = gaps.groupBy("symbol", "gap").agg(F.count(F.lit(1)).alias("n_gaps"))
    best = counts.groupBy("symbol").agg(F.max(F.struct("n_gaps", (-F.col("gap")).alias("neg_gap"))).alias("b"))
    return best.select("symbol", (-F.col("b.neg_gap")).alias("freq_seconds"), F.col("b.n_gaps").alias("n_gaps"))


def symbol_list(df: DataFrame) -> DataFrame:
    """Distinct symbols, ascending (A10)."""
    return df.select("symbol").distinct().orderBy("symbol")


def datestr_range(df: DataFrame, start: int) -> DataFrame:
    """Rows whose numeric ``date_str`` is at least ``start``."""
    return df.filter(F.col("date_str").cast("long") >= F.lit(int(start)))
