"""Structured Streaming forms of the stateless and windowed steps.

* :func:`stream_hourly_mean` - the hourly tumbling mean on a stream, with a
  watermark (append mode emits an hour once the watermark passes its end; late
  rows older than the watermark are dropped by the state store);
* the JSON-to-ticks transforms of :mod:`ratecast.operators.ticks` are row-local
  and apply unchanged to a streaming DataFrame;
* :func:`stream_to_hourly_table` - "repeated batch": every micro-batch leaves its
  hourly sums, then the part of the gap-filled table that they change is
  rewritten, since interpolation needs the *next* known point, which lies in
  the future.

Checkpoints and outputs live under the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecast.functions import epoch_offset, epoch_seconds, from_epoch_seconds, tumble_seconds
from ratecast.operators.gridding import interpolate_hourly
from ratecast.session import shared_dir


def event_time(ts_ntz: str) -> F.Column:
    """TIMESTAMP (instant) of a TIMESTAMP_NTZ read as UTC wall time.

    ``withWatermark`` rejects NTZ columns; this conversion goes through the exact
    epoch offset, so it does not depend on the session time zone.
    """
    return F.timestamp_seconds(epoch_offset(ts_ntz))


def stream_hourly_mean(ticks: DataFrame, width: str = "1 hour", watermark: str = "2 hours",
                       ts: str = "timestamp") -> DataFrame:
    """``AVG(rate), COUNT(*)`` per symbol and tumbling hour on a stream.

    Output matches :func:`hourly_mean`: ``symbol, tumble (NTZ), mean, count``.
    """
    et = ticks.withColumn("_et", event_time(ts)).withWatermark("_et", watermark)
    agg = et.groupBy("symbol", F.window("_et", width).alias("_w")).agg(
        F.avg("rate").alias("mean"), F.count(F.lit(1)).alias("count"))
    return agg.select("symbol", from_epoch_seconds(F.unix_seconds(F.col("_w.start"))).alias("tumble"), "mean", "count")


def run_to_table(stream_df: DataFrame, name: str, mode: str = "append", base: str | None = None) -> DataFrame:
    """Run a streaming query over everything available, then read its table back.

    ``append``: parquet file sink (exactly-once through its commit log).
    ``complete``: each micro-batch replaces the table (the whole result every
    time), which keeps replays idempotent.
    """
    spark = stream_df.sparkSession
    base = base or f"{shared_dir(spark).rstrip('/')}/streams/{name}"
    out, ckpt = f"{base}/table", f"{base}/_checkpoint"
    w = stream_df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if mode == "append":
        q = w.outputMode("append").format("parquet").start(out)
    elif mode == "complete":
        q = w.outputMode("complete").foreachBatch(
            lambda df, _id: df.write.mode("overwrite").parquet(out)).start()
    else:
        raise ValueError(f"unsupported output mode {mode!r}")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(out)


def stream_to_hourly_table(spark: SparkSession, ticks_stream: DataFrame, base: str,
                           width: int = 3600) -> DataFrame:
    """Repeated batch (R3): each micro-batch's hourly sums, then the days of the table that they change.

    A trigger reads its own ticks and the hourly sums (never earlier ticks). What
    it can change begins at the last known hour before the earliest hour it
    touched, in any series (or at the first hour, if it came before all others), so
    only the days from there on are rewritten. A micro-batch overwrites its own
    ``batch_id=N`` sums, so replaying it leaves one copy; the result does not
    depend on how the stream was cut into batches.
    """
    sums, table = f"{base}/hourly_sums", f"{base}/batch_hour_interpo"

    def refresh(batch: DataFrame, batch_id: int) -> None:
        mine = f"{sums}/batch_id={batch_id}"
        batch.groupBy("symbol", tumble_seconds("timestamp", width).alias("bucket")).agg(
            F.sum("rate").alias("total"), F.count("rate").alias("known"), F.count(F.lit(1)).alias("count")
        ).write.mode("overwrite").parquet(mine)
        touched = spark.read.parquet(mine).select("symbol", "bucket")
        if touched.isEmpty():
            return
        hourly = (spark.read.parquet(sums).groupBy("symbol", "bucket")
                  .agg(F.sum("total").alias("total"), F.sum("known").alias("known"), F.sum("count").alias("count"))
                  .select("symbol", "bucket", F.try_divide("total", "known").alias("mean"), "count").checkpoint(eager=True))
        before = F.lag("bucket").over(Window.partitionBy("symbol").orderBy("bucket"))
        first = hourly.agg(F.min("bucket")).scalar()
        start = (hourly.withColumn("before", before).join(touched, ["symbol", "bucket"])
                 .agg(F.min(F.coalesce("before", first)).alias("start")))
        t5 = interpolate_hourly(hourly.withColumn("tumble", from_epoch_seconds("bucket")), width)
        t5 = t5.withColumn("day", F.floor(epoch_seconds("tumble") / 86400).cast("int"))
        changed = t5.filter(F.col("day") >= F.floor(start.scalar() / 86400))
        (changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(table))

    q = (ticks_stream.writeStream.option("checkpointLocation", f"{base}/_checkpoint")
         .trigger(availableNow=True).foreachBatch(refresh).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(table).drop("day")
