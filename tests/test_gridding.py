"""Hand-made series with expected values written by hand (FIXTURES §4), plus properties."""

import pytest
from pyspark.sql import functions as F

from ratecast.operators.gridding import hour_grid, hourly_mean, hourly_union, interpolate_hourly
from tests.helpers import h

TICKS = "timestamp timestamp_ntz, request string, symbol string, rate double, date_str string"


def _ticks(spark, data):
    return spark.createDataFrame([(t, str(i), s, r, "") for i, (t, s, r) in enumerate(data)], TICKS)


def _interp(spark, data, **kw):
    out = interpolate_hourly(hourly_mean(_ticks(spark, data)), **kw)
    return {(r["symbol"], r["tumble"]): r for r in out.collect()}


def test_gap_of_one_and_several(spark):
    data = [(h(1, 0, 10), "A", 1.0), (h(1, 0, 40), "A", 3.0),  # mean 2 at 00h
            (h(1, 2, 5), "A", 6.0),                               # 02h: one-hour gap before
            (h(1, 0, 1), "B", 0.0), (h(1, 5, 0), "B", 10.0)]      # B: 00h and 05h
    m = _interp(spark, data)
    assert m[("A", h(1, 0))]["intrp"] == 2.0 and m[("A", h(1, 0))]["count"] == 2
    assert m[("A", h(1, 1))]["intrp"] == 4.0 and m[("A", h(1, 1))]["count"] == 0
    assert m[("A", h(1, 1))]["unfilled"] is None
    assert m[("A", h(1, 2))]["intrp"] == 6.0
    assert [m[("B", h(1, k))]["intrp"] for k in range(6)] == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0]
    # A ends at 02h while the grid runs to 05h: open end -> 0.0 (Q7)
    assert [m[("A", h(1, k))]["intrp"] for k in (3, 4, 5)] == [0.0, 0.0, 0.0]
    assert m[("A", h(1, 3))]["date_str"] == "20240101030000"


def test_edges_and_single_point(spark):
    data = [(h(1, 0), "A", 1.0), (h(1, 4), "A", 5.0), (h(1, 2, 30), "C", 7.0)]
    m = _interp(spark, data, edge_flag=True)
    assert [m[("C", h(1, k))]["intrp"] for k in range(5)] == [0.0, 0.0, 7.0, 0.0, 0.0]
    assert m[("C", h(1, 0))]["is_edge_fill"] and not m[("C", h(1, 2))]["is_edge_fill"]
    m2 = _interp(spark, data, fill=None)
    assert m2[("C", h(1, 0))]["intrp"] is None


def test_null_rate_is_a_neighbour(spark):
    # 01h has rows but a NULL mean: it is a known point whose y is NULL (Q11)
    data = [(h(1, 0), "A", 2.0), (h(1, 1), "A", None), (h(1, 3), "A", 8.0)]
    m = _interp(spark, data)
    assert m[("A", h(1, 1))]["count"] == 1 and m[("A", h(1, 1))]["unfilled"] is None
    assert m[("A", h(1, 1))]["intrp"] == 4.0       # no own value; line between 00h (2) and 03h (8)
    # 02h: previous known point is 01h with NULL y -> NULL
    assert m[("A", h(1, 2))]["intrp"] is None


def test_duplicate_hour_from_two_sources(spark):
    src1 = hourly_mean(_ticks(spark, [(h(1, 0), "A", 1.0), (h(1, 2, 10), "A", 4.0)]))
    src2 = hourly_mean(_ticks(spark, [(h(1, 2, 50), "A", 6.0), (h(1, 4), "A", 9.0)]))
    out = interpolate_hourly(hourly_union(src1, src2)).collect()
    at2 = sorted(r["intrp"] for r in out if r["tumble"] == h(1, 2))
    assert at2 == [4.0, 6.0]                      # kept twice (Q1)
    by = {r["tumble"]: r["intrp"] for r in out if r["tumble"] != h(1, 2)}
    # 01h: prev 00h (1.0); next = least (x, y) at 02h -> 4.0; line gives 2.5
    assert by[h(1, 1)] == 2.5
    # 03h: prev = greatest (x, y) at 02h -> 6.0; next 04h 9.0 -> 7.5
    assert by[h(1, 3)] == 7.5
    assert len(out) == 6


def test_grid_rows_equal_symbols_times_hours(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from ratecast.sources.fixtures import ticks_from_events
    hm = hourly_mean(ticks_from_events(ev, "user_id"))
    g = hour_grid(hm)
    n_sym = hm.select("symbol").distinct().count()
    lo, hi = hm.agg(F.min("tumble"), F.max("tumble")).first()
    hours = int((hi - lo).total_seconds() // 3600) + 1
    assert g.count() == n_sym * hours
    t5 = interpolate_hourly(hm)
    joined = t5.join(hm, ["symbol", "tumble"]).filter(F.col("intrp") != F.col("mean"))
    assert joined.count() == 0                    # known hours are unchanged


def test_interpolated_values_lie_between_neighbours(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from ratecast.sources.fixtures import ticks_from_events
    t5 = interpolate_hourly(hourly_mean(ticks_from_events(ev, "event_type")), fill=None).collect()
    by_sym = {}
    for r in t5:
        by_sym.setdefault(r["symbol"], []).append(r)
    for rs in by_sym.values():
        rs.sort(key=lambda r: r["tumble"])
        known = [i for i, r in enumerate(rs) if r["count"] > 0]
        for a, b in zip(known, known[1:]):
            lo, hi = sorted((rs[a]["intrp"], rs[b]["intrp"]))
            for r in rs[a + 1:b]:
                assert lo - 1e-9 <= r["intrp"] <= hi + 1e-9


def test_result_independent_of_partitioning(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from ratecast.sources.fixtures import ticks_from_events
    t = ticks_from_events(ev, "user_id")
    a = sorted(interpolate_hourly(hourly_mean(t)).collect())
    b = sorted(interpolate_hourly(hourly_mean(t.repartition(7, "request"))).collect())
    assert a == b


@pytest.mark.parametrize("width", [900, 7200])
def test_other_widths(spark, width):
    data = [(h(1, 0), "A", 1.0), (h(1, 4), "A", 5.0)]
    out = interpolate_hourly(hourly_mean(_ticks(spark, data), width=width), width=width)
    assert out.count() == 4 * 3600 // width + 1


def test_neighbours_are_other_hours(spark):
    """A NULL row of an hour with two sources gets the line between the hours around it, not its sibling's value."""
    import datetime as dt

    hour = lambda h: dt.datetime(2024, 1, 1, h)
    schema = "symbol string, tumble timestamp_ntz, mean double, count long"
    mixed = [("s", hour(0), 2.0, 1), ("s", hour(1), None, 1), ("s", hour(1), 100.0, 1), ("s", hour(3), 8.0, 1)]
    got = sorted((r.tumble.hour, r.intrp) for r in interpolate_hourly(spark.createDataFrame(mixed, schema)).collect())
    assert got == [(0, 2.0), (1, 4.0), (1, 100.0), (2, 54.0), (3, 8.0)]
    nulls = [(s, t, None if t.hour == 1 else m, c) for s, t, m, c in mixed]
    got = sorted((r.tumble.hour, r.intrp) for r in interpolate_hourly(spark.createDataFrame(nulls, schema)).collect() if r.tumble.hour == 1)
    assert got == [(1, 4.0), (1, 4.0)]
    strict = sorted((r.tumble.hour, r.intrp, r["count"]) for r in interpolate_hourly(spark.createDataFrame(
        mixed[:1] + [("s", hour(1), 1.0, 3), ("s", hour(1), 5.0, 1)] + mixed[3:], schema), merge="strict").collect())
    assert strict == [(0, 2.0, 1), (1, 2.0, 4), (2, 5.0, 0), (3, 8.0, 1)]
