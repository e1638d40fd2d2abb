import datetime as dt
import uuid

from pyspark.sql import functions as F

from ratecast.operators.gridding import hourly_mean
from ratecast.session import shared_dir
from ratecast.sources.fixtures import read_ticks
from ratecast.streaming import run_to_table, stream_hourly_mean

SF = "/root/testdata/sf0.001"


def _land(spark, df):
    base = f"{shared_dir(spark).rstrip('/')}/test-streams/{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/source")
    return base


def test_complete_mode_equals_batch(spark):
    t = read_ticks(spark, SF)
    base = _land(spark, t)
    s = spark.readStream.schema(t.schema).parquet(f"{base}/source")
    got = run_to_table(stream_hourly_mean(s), "t", "complete", base=f"{base}/run")
    assert sorted(got.collect()) == sorted(hourly_mean(t).collect())


def test_append_mode_holds_back_open_windows_and_drops_late_rows(spark):
    schema = "timestamp timestamp_ntz, request string, symbol string, rate double, date_str string"
    t0 = dt.datetime(2024, 1, 1)
    first = [(t0 + dt.timedelta(minutes=10 * i), str(i), "A", 1.0, "") for i in range(60)]   # 10 hours
    more = [(t0 + dt.timedelta(hours=10, minutes=30), "more", "A", 1.0, "")]
    late = [(t0 + dt.timedelta(minutes=5), "late", "A", 100.0, "")]                          # far behind
    base = f"{shared_dir(spark).rstrip('/')}/test-streams/{uuid.uuid4().hex}"
    # One file per micro-batch. Spark judges lateness against the watermark of the
    # previous batch, so the late row comes two batches after the data that moved it.
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{base}/source/a")
    spark.createDataFrame(more, schema).coalesce(1).write.parquet(f"{base}/source/b")
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{base}/source/c")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/source/*")
    out = run_to_table(stream_hourly_mean(s, watermark="2 hours"), "t", "append", base=f"{base}/run")
    rows = {r["tumble"]: (r["mean"], r["count"]) for r in out.collect()}
    # hour 0 closed before the late row arrived: the late row was dropped, not merged
    assert rows[t0] == (1.0, 6)
    # hours within 2 h of the newest event are still open: not emitted in append mode
    assert t0 + dt.timedelta(hours=9) not in rows
    assert out.agg(F.sum("count")).first()[0] < 62


def test_append_mode_counts_on_events(spark):
    """Append mode holds back the windows still open at the watermark (2 h after the last event)."""
    t = read_ticks(spark, "/root/testdata/sf0.01")
    base = _land(spark, t)
    s = spark.readStream.schema(t.schema).parquet(f"{base}/source")
    out = run_to_table(stream_hourly_mean(s, watermark="2 hours"), "t", "append", base=f"{base}/run")
    batch = hourly_mean(t)
    last = batch.agg(F.max("tumble")).first()[0]
    # every emitted window equals its batch value; the ones not emitted are the last open hours
    assert out.exceptAll(batch).count() == 0
    missing = batch.exceptAll(out)
    assert missing.filter(F.col("tumble") < last - dt.timedelta(hours=2)).count() == 0
    assert (out.count(), out.agg(F.sum("count")).first()[0]) == (3370, 9951)
