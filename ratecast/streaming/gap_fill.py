"""Gap filling on a stream: each trigger reads its own ticks and two points of state a series.

Hours are closed by a watermark (:func:`stream_hourly_mean` in append mode), so closed hours of a
series arrive in order, whatever the order of ticks within the allowed lateness and
however the stream is cut into micro-batches. A stateful step per series keeps the last known hour and the one
before; a new hour emits itself and the empty hours since the last one on the line between
both. An hour whose ticks have no rate is a neighbour without a value and gets the line between its own neighbours, so
it waits in the state for the next known hour. No earlier tick, hour or output row is
read again: the state is bounded by the number of series.

What lies before a series' first known hour and after its last one depends on the other series' bounds;
:func:`with_open_ends` adds it when the table is read, from one aggregate over the table.

Hours that the watermark has not passed stay open, and ticks older than the watermark are dropped, as in any append-mode aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.functions import date_str, epoch_seconds, from_epoch_seconds
from ratecast.streaming.streams import run_to_table, stream_hourly_mean

FILLED = "symbol string, pos long, intrp double, unfilled double, count long"
#: Last two known hours of a series: epoch second and mean (null without a rate), and the last one's count.
STATE = "prev_x long, prev_y double, last_x long, last_y double, last_count long"


def _line(at: np.ndarray, prev: tuple, nxt: tuple) -> np.ndarray:
    """Values on the line between two points, NaN if either has none; operations in the order of the batch form."""
    (px, py), (nx, ny) = prev, nxt
    if py is None or ny is None:
        return np.full(len(at), np.nan)
    return (ny - py) / float(nx - px) * (at - px).astype(float) + py


def _fill(width: int, default: float | None):
    def fill(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(frames)).sort_values("pos")
        prev = last = count = None
        if state.exists:
            px, py, lx, ly, count = state.get
            prev = None if px is None else (px, py)
            last = (lx, ly)
        out: list[tuple] = []

        def add(pos, intrp, unfilled, n) -> None:
            out.append((np.atleast_1d(pos), np.atleast_1d(np.asarray(intrp, float)), unfilled, n))

        for x, mean, n in zip(new["pos"].tolist(), new["mean"].tolist(), new["count"].tolist()):
            point = (x, None if mean is None or np.isnan(mean) else mean)
            if last is not None:
                if last[1] is None:  # it waited for its next neighbour
                    own = _line(np.array([last[0]]), prev, point) if prev else np.array([np.nan if default is None else default])
                    add(last[0], own, np.nan, count)
                gap = np.arange(last[0] + width, x, width)
                if gap.size:
                    add(gap, _line(gap, last, point), np.nan, 0)
            if point[1] is not None:
                add(x, point[1], point[1], n)
            prev, last, count = last, point, n
        state.update((None if prev is None else prev[0], None if prev is None else prev[1], last[0], last[1], count))
        if out:
            size = [len(p) for p, *_ in out]
            yield pd.DataFrame({"symbol": key[0], "pos": np.concatenate([p for p, *_ in out]), "intrp": np.concatenate([v for _, v, *_ in out]),
                                "unfilled": np.repeat(np.array([u for *_, u, _ in out], float), size),
                                "count": np.repeat(np.array([c for *_, c in out], np.int64), size)})

    return fill


def stream_gap_fill(closed: DataFrame, width: int = 3600, default: float | None = 0.0) -> DataFrame:
    """Stream of ``symbol, tumble, intrp, unfilled, count`` from a stream of closed hours (``symbol, tumble, mean, count``).

    Closed hours and the empty hours between them, each once. Hours of a series must arrive in order of
    time from trigger to trigger, as they do from an append-mode aggregate.
    """
    rows = closed.select("symbol", epoch_seconds("tumble").alias("pos"), "mean", "count")
    filled = rows.groupBy("symbol").applyInPandasWithState(_fill(width, default), FILLED, STATE, "append", "NoTimeout")
    value = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return filled.select("symbol", from_epoch_seconds("pos").alias("tumble"), value("intrp"), value("unfilled"), "count")


def stream_to_filled_table(spark: SparkSession, ticks: DataFrame, base: str, watermark: str = "2 hours", width: int = 3600,
                           default: float | None = 0.0) -> DataFrame:
    """Run ticks to closed hours and these to the filled table, with all that is available; the dense table (T5).

    Two queries, since Spark takes no stateful function behind a streaming aggregate: closed hours are appended to a
    table whose commit log the second query follows. Run again with the same ``base``, both go on where they were.
    """
    hours = run_to_table(stream_hourly_mean(ticks, f"{width} seconds", watermark), "hours", "append", base=f"{base}/hours")
    closed = spark.readStream.schema(hours.schema).parquet(f"{base}/hours/table")
    return with_open_ends(run_to_table(stream_gap_fill(closed, width, default), "filled", "append", base=f"{base}/filled"), width, default)


def with_open_ends(filled: DataFrame, width: int = 3600, default: float | None = 0.0) -> DataFrame:
    """The dense table (T5): the streamed rows and, up to the bounds of all series, the hours before each first and after each last row."""
    ends = filled.groupBy("symbol").agg(F.min(epoch_seconds("tumble")).alias("lo"), F.max(epoch_seconds("tumble")).alias("hi"))
    first, last = (filled.agg(f(epoch_seconds("tumble"))).scalar() for f in (F.min, F.max))
    w = F.lit(int(width)).cast("long")
    hours = lambda a, b: F.when(a <= b, F.sequence(a, b, w)).otherwise(F.array().cast("array<long>"))
    open_ = ends.select("symbol", F.explode(F.concat(hours(first, F.col("lo") - w), hours(F.col("hi") + w, last))).alias("pos"))
    open_ = open_.select("symbol", from_epoch_seconds("pos").alias("tumble"), F.lit(default).cast("double").alias("intrp"),
                         F.lit(None).cast("double").alias("unfilled"), F.lit(0).cast("long").alias("count"))
    return filled.select("symbol", "tumble", "intrp", "unfilled", "count").unionByName(open_).withColumn("date_str", date_str("tumble")) \
        .select("symbol", "tumble", "date_str", "intrp", "unfilled", "count")
