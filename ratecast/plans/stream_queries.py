"""Streaming queries: the stream is a file source over ticks / requests that
Spark first lands from the given tables, one fresh folder per run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecast.operators import ticks as T
from ratecast.plans import sql as S
from ratecast.plans.gridding_queries import MIDNIGHT_CUTS, T5
from ratecast.plans.registry import register
from ratecast.sources.fixtures import oracle_requests, read_ticks
from ratecast.sources.sinks import table_dir
from ratecast.sources.slices import replay_slice
from ratecast.streaming import run_to_table, stream_hourly_mean, stream_to_filled_table, stream_to_hourly_table


def _land(df, spark, name):
    """Write a frame as the files a stream source will pick up; return (dir, schema)."""
    path = table_dir(spark, name, fresh=True)
    df.write.parquet(f"{path}/source")
    return path, df.schema


@register("stream_hourly_mean", S.with_(S.ticks_cte(), S.hourly_cte()) + "SELECT * FROM hourly")
def q_stream_hourly_mean(spark, sf):
    """Complete mode of the streaming hourly mean equals the batch one."""
    base, schema = _land(read_ticks(spark, sf), spark, "stream_hourly_mean")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/source")
    return run_to_table(stream_hourly_mean(s), "stream_hourly_mean", "complete", base=f"{base}/run")


@register("stream_unnest", S.with_(S.viz_cte(), S.req_ticks_cte()) + "SELECT * FROM rticks")
def q_stream_unnest(spark, sf):
    """The row-local JSON-to-ticks transforms applied to a stream of requests (R2)."""
    base, schema = _land(oracle_requests(spark, sf), spark, "stream_unnest")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/source")
    return run_to_table(T.ticks(T.viz_rates(s)), "stream_unnest", "append", base=f"{base}/run")


@register("stream_to_hourly_table",
          S.with_(S.ticks_cte(), S.hourly_cte(), S.interp_ctes()) + f"SELECT {T5} FROM interp")
def q_stream_to_hourly_table(spark, sf):
    """Three daily slices arrive as separate files; each micro-batch lands and refreshes T5."""
    t = read_ticks(spark, sf)
    base = table_dir(spark, "stream_to_hourly_table", fresh=True)
    a, b = MIDNIGHT_CUTS
    slices = [t.filter(F.col("timestamp") < F.lit(a).cast("timestamp_ntz")), replay_slice(t, a, b),
              t.filter(F.col("timestamp") >= F.lit(b).cast("timestamp_ntz"))]
    for i, part in enumerate(slices):
        part.write.parquet(f"{base}/source/slice={i}")
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/source/*")
    return stream_to_hourly_table(spark, s, f"{base}/run")


@register("stream_hourly_mean_append",
          S.with_(S.ticks_cte(), S.hourly_cte()) +
          "SELECT * FROM hourly WHERE tumble + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR")
def q_stream_hourly_mean_append(spark, sf):
    """Append mode with a 2-hour watermark: an hour is emitted once the watermark
    (latest event time - 2 h) passes its end; later hours stay open in the state."""
    base, schema = _land(read_ticks(spark, sf), spark, "stream_hourly_mean_append")
    s = spark.readStream.schema(schema).parquet(f"{base}/source")
    return run_to_table(stream_hourly_mean(s, watermark="2 hours"), "stream_hourly_mean_append", "append",
                        base=f"{base}/run")


@register("stream_gap_fill",
          S.with_(S.ticks_cte(), S.hourly_cte(name="hourly_all"),
                  "hourly AS (SELECT * FROM hourly_all WHERE tumble + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR)", S.interp_ctes()) +
          f"SELECT symbol, tumble, date_str, {S.rounded('intrp', 'unfilled')}, count FROM interp")
def q_stream_gap_fill(spark, sf):
    """Gap filling with two points of state a series: the batch table over the hours that the watermark has closed."""
    base, schema = _land(read_ticks(spark, sf).repartitionByRange(4, "timestamp"), spark, "stream_gap_fill")
    s = spark.readStream.schema(schema).parquet(f"{base}/source")
    out = stream_to_filled_table(spark, s, f"{base}/run")
    return out.withColumns({c: F.round(c, 6) for c in ("intrp", "unfilled")})
