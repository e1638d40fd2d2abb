import pytest
from pyspark.sql import types as T

from ratecast.operators import serve as SV
from ratecast.plans.model_queries import AS_OF, SERVE_START, _tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    return _tables(spark, SF).frames


def test_unknown_model_and_stat(frames):
    with pytest.raises(ValueError):
        SV.serve_detail(frames, "LSTM", None, SERVE_START, "2024-01-28")
    with pytest.raises(ValueError):
        SV.serve_stat(frames, "MEDIAN", "PROPHET", None, SERVE_START, "2024-01-28")
    with pytest.raises(ValueError):
        SV.serve_detail(frames, "PROPHET", None, SERVE_START, None)


def test_default_end_from_as_of():
    assert str(SV.default_end(AS_OF)) == "2024-01-28"


def test_one_currency_and_none(frames):
    sym = frames["PROPHET"].select("symbol").first()[0]
    one = SV.serve_stat(frames, "MAX", "PROPHET", [sym], SERVE_START, "2024-01-28").collect()
    assert [r["symbol"] for r in one] == [sym] and "MAX" in one[0].asDict()
    none = SV.serve_stat(frames, "MAX", "PROPHET", [], SERVE_START, "2024-01-28").collect()
    assert none == []


def test_detail_columns(frames):
    p = SV.serve_detail(frames, "PROPHET", None, SERVE_START, "2024-01-28")
    a = SV.serve_detail(frames, "ARIMA", None, SERVE_START, "2024-01-28")
    assert p.columns == SV.DETAIL_COLUMNS["PROPHET"] and a.columns == SV.DETAIL_COLUMNS["ARIMA"]
    stat = SV.serve_stat(frames, "AVG", "ARIMA", None, SERVE_START, "2024-01-28").collect()
    assert [r["symbol"] for r in stat] == sorted(r["symbol"] for r in stat)


def test_requests_read_stored_forecasts(frames):
    """A request is a scan with the symbols and times pushed down: no window, no model fit, no join."""
    for d in (SV.serve_detail(frames, "ARIMA", ["7", "42"], SERVE_START, "2024-01-28"),
              SV.serve_stat(frames, "AVG", "PROPHET", ["7"], SERVE_START, "2024-01-28")):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "Window" not in plan and "Join" not in plan
        pushed = plan[plan.index("PushedFilters"):]
        assert "symbol" in pushed and ("GreaterThanOrEqual(ds" in pushed or "GreaterThanOrEqual(time_series_timestamp" in pushed)


def test_small_rates_and_infinite_values_are_served_as_they_are(spark):
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("ds", T.TimestampNTZType()), T.StructField("y", T.DoubleType())])
    import datetime as dt

    hours = [dt.datetime(2024, 1, 20, h) for h in range(3)]
    rows = [("a", t, v) for t, v in zip(hours, (3.00e-7, 3.01e-7, 3.02e-7))] + [("b", t, v) for t, v in zip(hours, (1.0, float("inf"), 3.0))]
    got = {r.symbol: r.AVG for r in SV.serve_stat({"PROPHET": spark.createDataFrame(rows, schema)}, "AVG", "PROPHET", None, SERVE_START, "2024-01-28").collect()}
    assert abs(got["a"] - 3.01e-7) < 1e-16 and got["b"] == float("inf")
