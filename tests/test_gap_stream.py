"""Stateful gap filling: equal to the batch table however the stream is cut, with two points of state a series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratecast.operators.gridding import hourly_mean, interpolate_hourly
from ratecast.streaming import stream_to_filled_table
from ratecast.streaming.gap_fill import _fill

TICKS = "timestamp timestamp_ntz, symbol string, rate double"
START = dt.datetime(2024, 1, 1)
COLS = ["symbol", "tumble", "date_str", "intrp", "unfilled", "count"]


def ticks(seed=0, n=150, hours=90):
    """Ticks in order of time with gaps, some hours without a rate, one series that starts late and one that ends early."""
    rng = np.random.default_rng(seed)
    rows = []
    for h in sorted(rng.uniform(0, hours, n)):
        s = ["a", "b", "late", "early"][int(rng.integers(0, 4))]
        if s == "late" and h < 40 or s == "early" and h > 30:
            continue
        rows.append((START + dt.timedelta(hours=float(h)), s, None if rng.uniform() < 0.2 else float(rng.normal())))
    # the watermark passes all hours above; the last tick's own hour stays open
    return rows + [(START + dt.timedelta(hours=hours + 6), "a", 1.0)]


def batch(spark, rows):
    closed = [r for r in rows[:-1]]
    return sorted((tuple(r) for r in interpolate_hourly(hourly_mean(spark.createDataFrame(closed, TICKS))).select(*COLS).collect()), key=str)


@pytest.mark.parametrize("cuts", [1, 4])
def test_equal_to_the_batch_table_for_any_cut(spark, tmp_path, cuts):
    rows = ticks(cuts)
    base = f"file://{tmp_path}"
    out = None
    for k, part in enumerate(np.array_split(np.arange(len(rows)), cuts)):
        spark.createDataFrame([rows[i] for i in part], TICKS).coalesce(1).write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(f"{base}/source")
        out = stream_to_filled_table(spark, stream, f"{base}/run")
    assert sorted((tuple(r) for r in out.select(*COLS).collect()), key=str) == batch(spark, rows)


class State:
    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v


def test_every_cut_of_one_series_gives_the_same_rows():
    """The function alone, hour by hour or all at once, with hours that have no rate."""
    rng = np.random.default_rng(3)
    pos = np.flatnonzero(rng.uniform(size=200) < 0.3) * 3600
    hours = pd.DataFrame({"pos": pos, "mean": np.where(rng.uniform(size=len(pos)) < 0.3, np.nan, rng.normal(size=len(pos))), "count": rng.integers(1, 4, len(pos))})
    fill, got = _fill(3600, 0.0), []
    for size in (1, 3, len(hours)):
        state, out = State(), []
        for lo in range(0, len(hours), size):
            out += list(fill(("s",), iter([hours[lo:lo + size]]), state))
        got.append(pd.concat(out).reset_index(drop=True))
        assert len(state.value) == 5
    assert got[0].equals(got[1]) and got[0].equals(got[2])
    assert len(got[0]) in ((pos[-1] - pos[0]) // 3600 + 1, (pos[-1] - pos[0]) // 3600)


def test_state_and_reads_do_not_grow(spark, tmp_path):
    """A second run reads only its new file: the rows that the first one wrote are as they were."""
    base = f"file://{tmp_path}"
    rows = ticks(5)
    half = len(rows) // 2
    done = []
    for part in (rows[:half], rows[half:]):
        spark.createDataFrame(part, TICKS).coalesce(1).write.mode("append").parquet(f"{base}/source")
        stream_to_filled_table(spark, spark.readStream.schema(TICKS).parquet(f"{base}/source"), f"{base}/run")
        done.append({r[0] for r in spark.read.parquet(f"{base}/run/filled/table").select(F.input_file_name()).distinct().collect()})
    assert done[0] and done[0] < done[1]
