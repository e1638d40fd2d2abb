import datetime as dt
import math

from ratecast.functions import (
    date_str,
    epoch_seconds,
    ieee_divide,
    json_array,
    json_scalar,
    nan_to_null,
    tumble_interval,
)


def test_tumble_truncates_toward_zero_before_1970(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 500000),),
                                (dt.datetime(1969, 12, 31, 22, 30),),
                                (dt.datetime(2024, 1, 1, 5, 59, 59),)], "t timestamp_ntz")
    out = [r[0] for r in df.select(tumble_interval("t", 3600)).collect()]
    # -0.5 s floors to -1 s, then DIV truncates toward zero: 1970-01-01 00:00
    assert out[0] == dt.datetime(1970, 1, 1, 0, 0)
    # -5400 s -> -3600 s (toward zero), not -7200
    assert out[1] == dt.datetime(1969, 12, 31, 23, 0)
    assert out[2] == dt.datetime(2024, 1, 1, 5, 0)
    secs = [r[0] for r in df.select(epoch_seconds("t")).collect()]
    assert secs[0] == -1


def test_tumble_does_not_read_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a = df.select(tumble_interval("t", 3600)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert a == dt.datetime(2024, 3, 10, 2, 0)


def test_ieee_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-2.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 0.0), (1.0, None)],
                               "a double, b double")
    out = [r[0] for r in df.select(ieee_divide("a", "b")).collect()]
    assert out[0] == math.inf and out[1] == -math.inf and math.isnan(out[2])
    assert out[3] == 2.0 and out[4] is None and out[5] is None


def test_json_scalar_and_array(spark):
    docs = ['{"symbols":["ETH","BTC"],"multiplier":"100"}', '{"multiplier":{"x":1}}', 'not json',
            '{"symbols":"ETH"}', None, '{"multiplier":"[7]","symbols":["{x}",["a"],{"b":1},3,null]}']
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    got = df.select(json_scalar("d", "$.multiplier").alias("m"), json_array("d", "$.symbols").alias("s")).collect()
    assert got[0]["m"] == "100" and list(got[0]["s"]) == ["ETH", "BTC"]
    assert got[1]["m"] is None          # object where a scalar is expected -> NULL (Q8)
    assert got[2]["m"] is None and got[2]["s"] is None   # bad JSON -> NULL, no error
    assert got[3]["s"] is None          # not an array
    assert got[4]["m"] is None
    # by type: a string that looks like JSON is a string, an object or array inside an array is NULL
    assert got[5]["m"] == "[7]" and list(got[5]["s"]) == ["{x}", None, None, "3", None]


def test_date_str_and_nan_to_null(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 4, 30, 23, 5, 9), float("nan")), (dt.datetime(2021, 5, 1), 1.5)],
                               "t timestamp_ntz, v double")
    got = df.select(date_str("t").alias("s"), nan_to_null("v").alias("v")).collect()
    assert got[0]["s"] == "20210430230509" and got[0]["v"] is None
    assert got[1]["v"] == 1.5
