"""Hourly tumbling means, the dense (symbol x hour) grid and gap interpolation.

Physical shape of :func:`interpolate_hourly` (checked with ``explain``):

* ticks -> partial hash aggregate -> exchange on (symbol, bucket) -> final
  aggregate: only per-hour partial rows cross the network, whatever the tick
  count of a hot symbol;
* the hourly rows are hash-partitioned on ``symbol`` once and sorted; one
  window gives each known hour its previous and next known hour, and an
  ``explode`` emits the empty hours between them: no grid is joined back, and
  the global bounds are one merged scalar subquery on the hourly rows;
* a series holds at most one row per hour of the global span, so tick skew
  never reaches the window.

:func:`hour_grid` and :func:`densify` keep the reference's grid-and-join form
as operators of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecast.functions import (
    date_str,
    epoch_seconds,
    from_epoch_seconds,
    interpolate_or_fill,
    tumble_seconds,
)

HOUR = 3600


def hourly_mean(ticks: DataFrame, width: int = HOUR, symbol: str = "symbol",
                ts: str = "timestamp", value: str = "rate") -> DataFrame:
    """``AVG(rate), COUNT(*) GROUP BY symbol, tumble`` (A1).

    Groups on the integer bucket (cheaper than a timestamp key) and turns it
    into ``tumble`` after the aggregate.
    """
    agg = ticks.groupBy(F.col(symbol).alias("symbol"),
                        tumble_seconds(ts, width).alias("_bucket")).agg(
        F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count"))
    return agg.select("symbol", from_epoch_seconds("_bucket").alias("tumble"), "mean", "count")


def hourly_union(*hourly: DataFrame) -> DataFrame:
    """``UNION ALL`` of separately aggregated hourly frames.

    An hour fed by two sources keeps two rows, as in the reference.
    """
    out = hourly[0]
    for h in hourly[1:]:
        out = out.unionByName(h)
    return out


def dedupe_hours(df: DataFrame, value: str = "intrp", symbol: str = "symbol", ts: str = "tumble") -> DataFrame:
    """``AVG(value) GROUP BY symbol, tumble`` (A7): one row per (symbol, hour)."""
    return df.groupBy(symbol, ts).agg(F.avg(value).alias(value))


def _bounds(hourly: DataFrame, ts: str = "tumble") -> tuple[Column, Column]:
    """Global first and last bucket as scalar subqueries (Catalyst merges the two)."""
    b = hourly.select(epoch_seconds(ts).alias("_s"))
    return b.agg(F.min("_s")).scalar(), b.agg(F.max("_s")).scalar()


#: Rows of the dense table that a task takes, about: whole-series windows and sorts hold up to 1 KB a row.
TASK_ROWS = 2 ** 18


def dense_tasks(hourly: DataFrame, width: int = HOUR, symbol: str = "symbol", ts: str = "tumble") -> int:
    """Number of tasks for the dense table of ``hourly`` (a stored frame, it is counted): ``spark.sql.shuffle.partitions``, or as many as
    leave TASK_ROWS rows for each, so that a task's memory does not grow with the number of series."""
    p = epoch_seconds(ts)
    series = hourly.select(symbol).distinct().count()
    ends = hourly.agg(F.min(p).alias("lo"), F.max(p).alias("hi")).where("hi IS NOT NULL")
    hours = ends.select(F.explode(F.sequence("lo", "hi", F.lit(int(width)).cast("long")))).count()
    return max(int(hourly.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-series * hours // TASK_ROWS))


def spread_keys(keys: DataFrame, key: str) -> DataFrame:
    """Hash-spread a small key frame over ``spark.sql.shuffle.partitions`` partitions.

    Used before an ``explode`` that multiplies each key into many rows: AQE
    sizes partitions from the (tiny) key shuffle and would otherwise put all
    keys, and so the whole exploded frame, in one task. An explicit partition
    count is left alone by AQE.
    """
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartition(n, key)


def series_bounds(hourly: DataFrame, symbol: str = "symbol", ts: str = "tumble") -> DataFrame:
    """Each symbol with the global ``min_ts`` and ``max_ts`` (A2).

    The reference gathers all symbols into one array; here they stay rows so no
    single task or row has to hold the symbol list.
    """
    lo, hi = _bounds(hourly, ts)
    return hourly.select(symbol).distinct().select(
        symbol, from_epoch_seconds(lo).alias("min_ts"), from_epoch_seconds(hi).alias("max_ts"))


def hour_grid(hourly: DataFrame, width: int = HOUR, symbol: str = "symbol", ts: str = "tumble") -> DataFrame:
    """Every symbol x every bucket between the global first and last bucket.

    Bounds are bucket starts already, so the candidate buckets are the integer
    sequence ``lo, lo + width, ..., hi`` (inclusive), exploded per symbol.
    """
    lo, hi = _bounds(hourly, ts)
    return spread_keys(hourly.select(symbol).distinct(), symbol).select(
        F.col(symbol).alias("symbol"),
        F.explode(F.sequence(lo, hi, F.lit(int(width)).cast("long"))).alias("_pos"),
    ).select("symbol", from_epoch_seconds("_pos").alias("tumble"))


def densify(grid: DataFrame, hourly: DataFrame, symbol: str = "symbol") -> DataFrame:
    """``grid LEFT JOIN hourly ON (symbol, tumble)``.

    Both sides are clustered on ``symbol`` first, which also satisfies the join
    on (symbol, tumble) and the per-symbol windows that follow. The partition
    count is explicit: the grid comes out of an ``explode``, whose output AQE
    cannot size in advance.
    """
    n = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = grid.repartition(n, symbol)
    h = hourly.repartition(n, symbol)
    return g.join(h, [symbol, "tumble"], "left")


def _points(hourly: DataFrame, symbol: str, merge: str, clusters: int | None = None) -> DataFrame:
    """One row per known bucket: its rows, and how it looks from earlier (``_lo``) and later (``_hi``) buckets.

    ``clusters``: cluster on the symbol over so many partitions, as whole-series windows want it.
    """
    h = hourly.select(F.col(symbol).alias("symbol"), "mean", "count", epoch_seconds("tumble").alias("_pos"))
    by_mean = F.col("mean").isNotNull(), F.col("mean")
    h = h.repartition(clusters, "symbol") if clusters else h
    h = h.groupBy("symbol", "_pos").agg(
        F.collect_list(F.struct("mean", "count")).alias("_rows"),
        F.min(F.struct(by_mean[0].alias("k"), by_mean[1].alias("y"))).alias("_lo"),
        F.max(F.struct(by_mean[0].alias("k"), by_mean[1].alias("y"))).alias("_hi"),
        F.sum(F.col("mean") * F.col("count")).alias("_sum"), F.sum(F.when(F.col("mean").isNotNull(), F.col("count"))).alias("_n"),
        F.sum("count").alias("_all"))
    if merge == "strict":
        one = F.when(F.size("_rows") == 1, F.col("_rows")[0]["mean"]).otherwise(F.try_divide("_sum", "_n"))
        h = h.withColumn("_one", F.struct(one.alias("mean"), F.col("_all").alias("count")))
        h = h.select("symbol", "_pos", F.array("_one").alias("_rows"), F.struct(F.lit(True).alias("k"), F.col("_one.mean").alias("y")).alias("_lo"),
                     F.struct(F.lit(True).alias("k"), F.col("_one.mean").alias("y")).alias("_hi"))
    return h


def interpolate_hourly(hourly: DataFrame, width: int = HOUR, fill: float | None = 0.0,
                       edge_flag: bool = False, symbol: str = "symbol", merge: str = "reference",
                       tasks: int | None = None) -> DataFrame:
    """Dense hourly table with gaps filled (``batch_hour_interpo``, T5; W1, W2, D4, J2, J3).

    Input: hourly means ``(symbol, tumble, mean, count)``, possibly a union of
    several sources. Output: ``symbol, tumble, date_str, intrp, unfilled, count``
    with one row per symbol and grid bucket between the global first and last
    bucket (more where sources overlap, Q1). Open ends get ``fill`` (0.0 as in
    the reference, Q7).

    Gap filling without a grid join: the known buckets of a series are sorted
    once, each takes its previous and next known point (``lag`` / ``lead``), and
    then emits itself plus every empty bucket up to the next known one (the
    first and last also emit the open ends up to the global bounds). Each
    output row is produced exactly once by the known point that precedes it,
    which is also its left neighbour. The series are spread over an explicit
    number of partitions (``tasks``, else ``spark.sql.shuffle.partitions``), because
    the explode multiplies rows in a way AQE cannot size in advance.

    A bucket fed by several sources (Q1): ``merge="reference"`` keeps its rows, as
    the union gave them; ``merge="strict"`` makes them one, the mean of all their
    ticks. Neighbours are other buckets, never rows of the same one: seen from
    later buckets a duplicated bucket counts with its larger mean, from
    earlier ones with its smaller one (NULL smallest; the reference leaves the
    choice unspecified). A known bucket whose mean is NULL is still a neighbour
    (Q11); its own value is the line between its neighbours.
    """
    if merge not in ("reference", "strict"):
        raise ValueError(f"unknown merge {merge!r}")
    n = tasks or int(hourly.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lo, hi = _bounds(hourly, "tumble")
    w_ = F.lit(int(width)).cast("long")
    h = _points(hourly, symbol, merge, n)
    w = Window.partitionBy("symbol").orderBy(F.col("_pos").asc())
    seen = lambda side: F.struct(F.col("_pos").alias("x"), F.col(f"{side}.y").alias("y"))
    h = h.select("symbol", "_pos", "_rows", seen("_hi").alias("_from_right"), seen("_lo").alias("_from_left"),
                 F.lag(seen("_hi")).over(w).alias("_prev"), F.lead(seen("_lo")).over(w).alias("_next"))
    start = F.when(F.col("_prev").isNull(), lo).otherwise(F.col("_pos"))
    end = F.when(F.col("_next").isNull(), hi).otherwise(F.greatest(F.col("_pos"), F.col("_next.x") - w_))
    # an empty bucket is one row without a mean; a known one has as many as its sources
    empty = F.array(F.struct(F.lit(None).cast("double").alias("mean"), F.lit(0).cast("long").alias("count")))
    e = h.select("*", F.explode(F.sequence(start, end, w_)).alias("_p"))
    e = e.select("*", F.explode(F.when(F.col("_p") == F.col("_pos"), F.col("_rows")).otherwise(empty)).alias("_r"))
    own, before = F.col("_p") == F.col("_pos"), F.col("_p") < F.col("_pos")
    null_coord = F.lit(None).cast("struct<x:bigint,y:double>")
    prev = F.when(own, F.col("_prev")).when(before, null_coord).otherwise(F.col("_from_right"))
    nxt = F.when(own, F.col("_next")).when(before, F.col("_from_left")).otherwise(F.col("_next"))
    return _filled(e.select("symbol", "_p", F.col("_r.mean").alias("_mean"), prev.alias("_pv"), nxt.alias("_nx"), F.col("_r.count").alias("count")), fill, edge_flag)


def _filled(e: DataFrame, fill: float | None, edge_flag: bool) -> DataFrame:
    """Output rows from buckets ``_p`` with their own mean and their neighbours ``_pv``, ``_nx``."""
    tumble = from_epoch_seconds("_p")
    cols = [
        "symbol",
        tumble.alias("tumble"),
        date_str(tumble).alias("date_str"),
        interpolate_or_fill("_mean", "_p", "_pv", "_nx", fill).alias("intrp"),
        F.col("_mean").alias("unfilled"),
        "count",
    ]
    if edge_flag:
        cols.append((F.col("_mean").isNull() & (F.col("_pv").isNull() | F.col("_nx").isNull())).alias("is_edge_fill"))
    return e.select(*cols)


#: Buckets of a segment of a series.
SEGMENT = 1024


def interpolate_segmented(hourly: DataFrame, width: int = HOUR, fill: float | None = 0.0, edge_flag: bool = False,
                          symbol: str = "symbol", merge: str = "reference", segment: int = SEGMENT) -> DataFrame:
    """The same table as :func:`interpolate_hourly`, for series too long for one task.

    Time is cut into segments of ``segment`` buckets. Neighbours inside a segment come from a window
    over (symbol, segment). What lies beyond comes from the segments' summaries, their first and last known
    bucket: a window over those (a series has its number of buckets over ``segment`` of them)
    carries the last known point forward and the first one back, and a join brings both to the segment's
    rows. Every segment emits its own buckets, those before its first known
    one included, so no row is exploded into more than ``segment`` and one series spreads over all tasks.
    """
    if merge not in ("reference", "strict"):
        raise ValueError(f"unknown merge {merge!r}")
    n = int(hourly.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lo, hi = _bounds(hourly, "tumble")
    w_, size = F.lit(int(width)).cast("long"), F.lit(int(width * segment)).cast("long")
    seg = lambda x: x - F.pmod(x, size)
    h = _points(hourly, symbol, merge).withColumn("_seg", seg(F.col("_pos"))).repartition(n, "symbol", "_seg")
    seen = lambda side: F.struct(F.col("_pos").alias("x"), F.col(f"{side}.y").alias("y"))
    inside = Window.partitionBy("symbol", "_seg").orderBy("_pos")
    h = h.select("symbol", "_seg", "_pos", "_rows", seen("_hi").alias("_from_right"), seen("_lo").alias("_from_left"),
                 F.lag(seen("_hi")).over(inside).alias("_prev"), F.lead(seen("_lo")).over(inside).alias("_next"))

    summary = h.groupBy("symbol", "_seg").agg(F.min_by("_from_left", "_pos").alias("_first"), F.max_by("_from_right", "_pos").alias("_last"))
    grid = spread_keys(hourly.select(F.col(symbol).alias("symbol")).distinct(), "symbol").select(
        "symbol", F.explode(F.sequence(seg(lo), seg(hi), size)).alias("_seg"))
    ahead = Window.partitionBy("symbol").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("symbol").orderBy(F.col("_seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(summary, ["symbol", "_seg"], "left").select(
        "symbol", "_seg", "_first", F.last("_last", True).over(ahead).alias("_before"), F.last("_first", True).over(behind).alias("_after"))

    end = F.least(F.col("_seg") + size - w_, hi)
    none = F.lit(None)
    known = h.join(carried.drop("_first").hint("merge"), ["symbol", "_seg"]).select(
        "symbol", "_seg", "_pos", "_rows", F.coalesce("_prev", "_before").alias("_pv"), F.coalesce("_next", "_after").alias("_nx"), "_from_right",
        F.col("_pos").alias("_start"), F.when(F.col("_next").isNull(), F.greatest(F.col("_pos"), end)).otherwise(F.greatest(F.col("_pos"), F.col("_next.x") - w_)).alias("_end"))
    first = F.greatest(F.col("_seg"), lo)
    leading = carried.select(
        "symbol", "_seg", none.cast("long").alias("_pos"), none.cast("array<struct<mean:double,count:long>>").alias("_rows"), F.col("_before").alias("_pv"),
        F.coalesce("_first", "_after").alias("_nx"), F.col("_before").alias("_from_right"), first.alias("_start"),
        F.when(F.col("_first").isNull(), end).otherwise(F.col("_first.x") - w_).alias("_end")).where("_start <= _end")
    pieces = known.unionByName(leading).repartition(n, "symbol", "_seg")

    empty = F.array(F.struct(F.lit(None).cast("double").alias("mean"), F.lit(0).cast("long").alias("count")))
    e = pieces.select("*", F.explode(F.sequence("_start", "_end", w_)).alias("_p"))
    own = F.coalesce(F.col("_p") == F.col("_pos"), F.lit(False))
    e = e.select("*", F.explode(F.when(own, F.col("_rows")).otherwise(empty)).alias("_r"))
    prev = F.when(own, F.col("_pv")).otherwise(F.col("_from_right"))
    return _filled(e.select("symbol", "_p", F.col("_r.mean").alias("_mean"), prev.alias("_pv"), "_nx", F.col("_r.count").alias("count")), fill, edge_flag)
