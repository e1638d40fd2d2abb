"""Queries of the scheduled interpolation job (``batch_hour_interpo``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.functions import date_str, tumble_interval
from ratecast.functions.sql_functions import register_functions
from ratecast.operators import gridding as G
from ratecast.plans import sql as S
from ratecast.plans.registry import register
from ratecast.sources.fixtures import read_ticks
from ratecast.sources.sinks import materialize
from ratecast.sources.tables import read_table, scan_rates

T5 = "symbol, tumble, date_str, intrp, unfilled, count"


def _hourly(spark: SparkSession, sf: str, symbol: str = "event_type") -> DataFrame:
    return G.hourly_mean(read_ticks(spark, sf, symbol))


def _stored_hourly(spark: SparkSession, sf: str, symbol: str = "event_type") -> DataFrame:
    """Hourly aggregate stored once: the grid bounds and the gap fill both read it,
    so the tick table is scanned a single time."""
    return materialize(_hourly(spark, sf, symbol))


@register("scan_rates", S.with_(S.ticks_cte()) + "SELECT * FROM ticks")
def q_scan_rates(spark, sf):
    return scan_rates(read_ticks(spark, sf))


@register("tumble_interval",
          f"SELECT event_id, {S.tumble('ts', 900)} AS tumble_15m, {S.tumble('ts', 86400)} AS tumble_day, "
          f"{S.tumble('ts', 7 * 3600)} AS tumble_7h FROM events")
def q_tumble_interval(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    return ev.select("event_id", tumble_interval("ts", 900).alias("tumble_15m"),
                     tumble_interval("ts", 86400).alias("tumble_day"),
                     tumble_interval("ts", 7 * 3600).alias("tumble_7h"))


@register("date_str", f"SELECT event_id, {S.date_str('ts')} AS date_str FROM events")
def q_date_str(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    return ev.select("event_id", date_str("ts").alias("date_str"))


@register("hourly_mean", S.with_(S.ticks_cte(), S.hourly_cte()) + "SELECT * FROM hourly")
def q_hourly_mean(spark, sf):
    return _hourly(spark, sf)


@register("series_bounds",
          S.with_(S.ticks_cte(), S.hourly_cte()) +
          "SELECT DISTINCT symbol, (SELECT min(tumble) FROM hourly) AS min_ts, "
          "(SELECT max(tumble) FROM hourly) AS max_ts FROM hourly")
def q_series_bounds(spark, sf):
    return G.series_bounds(_stored_hourly(spark, sf))


@register("hour_grid", S.with_(S.ticks_cte(), S.hourly_cte(), S.grid_ctes()) + "SELECT * FROM grid")
def q_hour_grid(spark, sf):
    return G.hour_grid(_stored_hourly(spark, sf))


@register("densify",
          S.with_(S.ticks_cte(), S.hourly_cte(), S.grid_ctes()) +
          "SELECT g.symbol, g.tumble, h.mean, h.count FROM grid g "
          "LEFT JOIN hourly h ON g.symbol = h.symbol AND g.tumble = h.tumble")
def q_densify(spark, sf):
    h = _stored_hourly(spark, sf)
    return G.densify(G.hour_grid(h), h)


@register("interpolate_hourly",
          S.with_(S.ticks_cte(), S.hourly_cte(), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_interpolate_hourly(spark, sf):
    return G.interpolate_hourly(_stored_hourly(spark, sf))


@register("interpolate_hourly_users",
          S.with_(S.ticks_cte("user_id"), S.hourly_cte(), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_interpolate_hourly_users(spark, sf):
    return G.interpolate_hourly(_stored_hourly(spark, sf, "user_id"))


@register("interpolate_segmented",
          S.with_(S.ticks_cte("user_id"), S.hourly_cte(), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_interpolate_segmented(spark, sf):
    """The same table with series cut into segments of four days, so that one series is many tasks."""
    return G.interpolate_segmented(_stored_hourly(spark, sf, "user_id"), segment=96)


@register("linear_interpolate",
          S.with_(S.ticks_cte("user_id"), S.hourly_cte(), S.interp_ctes()) +
          "SELECT symbol, tumble, intrp FROM interp WHERE unfilled IS NULL AND prv IS NOT NULL AND nxt IS NOT NULL")
def q_linear_interpolate(spark, sf):
    """Only the hours filled on a line between two known neighbours (D3)."""
    out = G.interpolate_hourly(_stored_hourly(spark, sf, "user_id"), fill=None, edge_flag=True)
    return out.filter(F.col("unfilled").isNull() & ~F.col("is_edge_fill")).select("symbol", "tumble", "intrp")


# Fixed cut points that split `events` into the batch, stream and validation sources.
MIDNIGHT_CUTS = ("2024-01-21 00:00:00", "2024-01-26 00:00:00")
HALF_HOUR_CUTS = ("2024-01-21 12:30:00", "2024-01-26 12:30:00")


def _three_sources(spark, sf, cuts, symbol="event_type", nulls=False):
    from ratecast.sources.slices import replay_slice
    t = read_ticks(spark, sf, symbol)
    if nulls:
        t = t.withColumn("rate", F.when(F.col("request").cast("long") % 7 != 0, F.col("rate")))
    a, b = cuts
    parts = [t.filter(F.col("timestamp") < F.lit(a).cast("timestamp_ntz")),
             replay_slice(t, a, b),
             t.filter(F.col("timestamp") >= F.lit(b).cast("timestamp_ntz"))]
    return materialize(G.hourly_union(*[G.hourly_mean(p) for p in parts]))


def _three_sources_sql(cuts, symbol="event_type", nulls=False) -> list[str]:
    a, b = cuts
    parts = [
        S.ticks_cte(symbol, "t_batch", f"ts < TIMESTAMP '{a}'"),
        S.ticks_cte(symbol, "t_stream", f"ts >= TIMESTAMP '{a}' AND ts < TIMESTAMP '{b}'"),
        S.ticks_cte(symbol, "t_valid", f"ts >= TIMESTAMP '{b}'"),
        S.hourly_cte("t_batch", "h_batch"), S.hourly_cte("t_stream", "h_stream"), S.hourly_cte("t_valid", "h_valid"),
        "hourly AS (SELECT * FROM h_batch UNION ALL SELECT * FROM h_stream UNION ALL SELECT * FROM h_valid)",
    ]
    return [p.replace("value AS rate", "CASE WHEN event_id % 7 <> 0 THEN value END AS rate") for p in parts] if nulls else parts


@register("hourly_union", S.with_(*_three_sources_sql(MIDNIGHT_CUTS)) + "SELECT * FROM hourly")
def q_hourly_union(spark, sf):
    return _three_sources(spark, sf, MIDNIGHT_CUTS)


@register("interpolate_union",
          S.with_(*_three_sources_sql(MIDNIGHT_CUTS), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_interpolate_union(spark, sf):
    """The scheduled job as written: three sources aggregated apart, unioned, gridded, filled."""
    return G.interpolate_hourly(_three_sources(spark, sf, MIDNIGHT_CUTS))


@register("interpolate_union_overlap",
          S.with_(*_three_sources_sql(HALF_HOUR_CUTS), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_interpolate_union_overlap(spark, sf):
    """Cuts inside an hour: that hour has one row per source and the grid join repeats it (Q1)."""
    return G.interpolate_hourly(_three_sources(spark, sf, HALF_HOUR_CUTS))


#: The union's rows of one hour as one: the mean of the sources' means, weighed by their ticks.
STRICT = ("strict AS (SELECT symbol, tumble, CASE WHEN count(*) = 1 THEN any_value(mean) ELSE sum(mean * count) / "
          "sum(CASE WHEN mean IS NOT NULL THEN count END) END AS mean, CAST(sum(count) AS BIGINT) AS count "
          "FROM hourly GROUP BY symbol, tumble)")
FILLED = "symbol, tumble, date_str, round(intrp, 6) AS intrp, round(unfilled, 6) AS unfilled, count"


def _filled(df):
    return df.withColumns({c: F.round(c, 6) for c in ("intrp", "unfilled")})


@register("interpolate_nulls",
          S.with_(*_three_sources_sql(HALF_HOUR_CUTS, nulls=True), S.interp_ctes()) + f"SELECT {FILLED} FROM interp")
def q_interpolate_nulls(spark, sf):
    """Hours without a known value, some of them fed by two sources (Q1, Q11)."""
    return _filled(G.interpolate_hourly(_three_sources(spark, sf, HALF_HOUR_CUTS, nulls=True)))


@register("interpolate_nulls_strict",
          S.with_(*_three_sources_sql(HALF_HOUR_CUTS, nulls=True), STRICT, S.interp_ctes("strict")) + f"SELECT {FILLED} FROM interp")
def q_interpolate_nulls_strict(spark, sf):
    """The same with each hour's sources merged into one row."""
    return _filled(G.interpolate_hourly(_three_sources(spark, sf, HALF_HOUR_CUTS, nulls=True), merge="strict"))


@register("dedupe_hours",
          S.with_(*_three_sources_sql(HALF_HOUR_CUTS), S.interp_ctes()) +
          "SELECT symbol, tumble, avg(intrp) AS intrp FROM interp GROUP BY symbol, tumble")
def q_dedupe_hours(spark, sf):
    return G.dedupe_hours(G.interpolate_hourly(_three_sources(spark, sf, HALF_HOUR_CUTS)))


@register("sink_replace",
          S.with_(S.ticks_cte(), S.hourly_cte(), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_sink_replace(spark, sf):
    """``CREATE OR REPLACE TABLE batch_hour_interpo AS ...``: written twice, read back once (K1)."""
    from ratecast.sources.sinks import sink_replace, table_dir
    path = table_dir(spark, "batch_hour_interpo", fresh=True)
    t5 = G.interpolate_hourly(_hourly(spark, sf))
    layout = dict(cluster_by="symbol", sort_within=[F.col("symbol"), F.col("tumble").desc()])
    sink_replace(t5, path, **layout)
    return sink_replace(t5, path, **layout)


@register("sink_append", S.with_(S.ticks_cte()) + "SELECT * FROM ticks UNION ALL SELECT * FROM ticks")
def q_sink_append(spark, sf):
    """``WRITE_APPEND``: two runs into one new table double its rows (K3)."""
    from ratecast.sources.sinks import sink_append, table_dir
    path = table_dir(spark, "ticks_appended", fresh=True)
    t = scan_rates(read_ticks(spark, sf))
    sink_append(t, path)
    return sink_append(t, path)


#: The interpolation as one SQL text over a frame ``hourly``, with the session's SQL functions.
INTERPOLATION_TEXT = """
WITH candidates AS (SELECT symbol, gen_ts_candidates(3600L, (SELECT min(tumble) FROM {hourly}), (SELECT max(tumble) FROM {hourly})) AS c
                    FROM (SELECT DISTINCT symbol FROM {hourly})),
grid AS (SELECT symbol, explode(c) AS tumble FROM candidates),
dense AS (SELECT g.symbol, g.tumble, h.mean, h.count, CASE WHEN h.count IS NOT NULL THEN struct(g.tumble AS x, h.mean AS y) END AS coord
          FROM grid g LEFT JOIN {hourly} h ON g.symbol = h.symbol AND g.tumble = h.tumble),
seen AS (SELECT *, last(coord, true) OVER (PARTITION BY symbol ORDER BY tumble ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv,
                last(coord, true) OVER (PARTITION BY symbol ORDER BY tumble DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nxt FROM dense)
SELECT symbol, tumble, date_format(tumble, 'yyyyMMddHHmmss') AS date_str, interpolate_ts_val_or_fill(mean, tumble, prv, nxt, 0.0D) AS intrp,
       mean AS unfilled, coalesce(count, 0L) AS count FROM seen
"""


@register("sql_functions", S.with_(S.ticks_cte(), S.hourly_cte(), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_sql_functions(spark, sf):
    """The interpolation written as SQL text that calls the registered functions."""
    register_functions(spark)
    return spark.sql(INTERPOLATION_TEXT, hourly=_stored_hourly(spark, sf))
