"""Gap filling by segments: the same table as by whole series, and one series in many tasks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import gridding as G

HOURLY = "symbol string, tumble timestamp_ntz, mean double, count long"
START = dt.datetime(1969, 12, 28)


def hourly(spark, seed=0, n=400, share=0.15):
    """Series of random hours, some twice, some without a mean, one that is far apart, one single."""
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(6):
        for i in np.flatnonzero(rng.uniform(size=n) < share * (s + 1) / 4):
            for _ in range(1 + int(rng.uniform() < 0.1)):
                rows.append((f"s{s}", START + dt.timedelta(hours=int(i)), None if rng.uniform() < 0.1 else float(rng.normal()), int(rng.integers(1, 5))))
    rows += [("far", START, 1.0, 1), ("far", START + dt.timedelta(hours=n + 50), 2.0, 1), ("one", START + dt.timedelta(hours=77), 3.0, 2)]
    return spark.createDataFrame(rows, HOURLY).repartition(5)


@pytest.mark.parametrize("segment", [1, 7, 64, 1024])
@pytest.mark.parametrize("merge", ["reference", "strict"])
def test_equal_to_whole_series(spark, segment, merge):
    h = hourly(spark, segment)
    cols = ["symbol", "tumble", "date_str", "intrp", "unfilled", "count", "is_edge_fill"]
    key = lambda r: tuple((x is not None, x) for x in r)
    want = sorted((tuple(r) for r in G.interpolate_hourly(h, edge_flag=True, merge=merge).select(*cols).collect()), key=key)
    got = sorted((tuple(r) for r in G.interpolate_segmented(h, edge_flag=True, merge=merge, segment=segment).select(*cols).collect()), key=key)
    assert got == want


def test_fill_and_unknown_merge(spark):
    h = hourly(spark, 9)
    assert G.interpolate_segmented(h, fill=None).where("symbol = 'one' AND intrp IS NOT NULL").count() == 1
    with pytest.raises(ValueError, match="merge"):
        G.interpolate_segmented(h, merge="x")


def test_empty_table(spark):
    assert G.interpolate_segmented(spark.createDataFrame([], HOURLY)).count() == 0


def test_one_long_series_spreads_over_all_tasks(spark):
    """A series of 300,000 hours, known at one hour in a thousand: no task gets much more than its share."""
    n = 300_000
    h = spark.range(0, n, 1000).select(F.lit("a").alias("symbol"), F.timestamp_add("HOUR", F.col("id"), F.lit("1990-01-01").cast("timestamp_ntz")).alias("tumble"),
                                       F.col("id").cast("double").alias("mean"), F.lit(1).cast("long").alias("count"))
    out = G.interpolate_segmented(h)
    parts = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(parts) == n - 999 and len(parts) == 8 and max(parts) < 2 * n / 8
    assert out.where(F.abs(F.col("intrp") - F.timestamp_diff("HOUR", F.lit("1990-01-01").cast("timestamp_ntz"), "tumble")) > 1e-6).count() == 0
