"""JSON-to-ticks path on hand-made requests (length mismatch, zero multiplier, bad JSON)."""

import datetime as dt
import math

from ratecast.operators import ticks as T

REQ = ("block_timestamp timestamp_ntz, block_timestamp_truncated timestamp_ntz, oracle_request_id long, "
       "request struct<oracle_script_id: long>, decoded_result struct<calldata: string, result: string>")


def _req(spark, rows):
    t = dt.datetime(2021, 5, 1, 10, 17)
    th = dt.datetime(2021, 5, 1, 10, 0)
    return spark.createDataFrame([(t, th, i, (sid,), (cd, rs)) for i, (sid, cd, rs) in enumerate(rows)], REQ)


def test_unnest_and_rescale(spark):
    rows = [
        (3, '{"symbols":["ETH","BTC"],"multiplier":"100"}', '{"rates":["250000","5000000"]}'),
        (3, '{"symbols":["ETH","BTC"],"multiplier":"100"}', '{"rates":["1"]}'),          # length mismatch
        (3, '{"symbols":["ETH","ZERO"],"multiplier":"0"}', '{"rates":["5","0"]}'),        # zero multiplier
        (3, 'not json', '{"rates":["1"]}'),                                               # bad JSON
        (2, '{"symbols":["ETH"],"multiplier":"1"}', '{"rates":["1"]}'),                   # other script
        (3, None, '{"rates":["1"]}'),                                                     # NULL calldata
        (3, '{"symbols":["ETH",{"a":1}],"multiplier":"1"}', '{"rates":["1","2"]}'),        # object element
    ]
    out = T.viz_rates(_req(spark, rows)).collect()
    got = sorted((r["oracle_request_id"], r["symbol"] or "", r["rate"]) for r in out)
    assert got[:2] == [(0, "BTC", 50000.0), (0, "ETH", 2500.0)]
    zero = {r["symbol"]: r["rate"] for r in out if r["oracle_request_id"] == 2}
    assert zero["ETH"] == math.inf and math.isnan(zero["ZERO"])
    ids = {r["oracle_request_id"] for r in out}
    assert ids == {0, 2, 6}
    obj = [r for r in out if r["oracle_request_id"] == 6]
    assert sorted((r["symbol"] is None) for r in obj) == [False, True]


def test_ticks_projection_and_latest(spark):
    rows = [(3, '{"symbols":["A","B","C"],"multiplier":"1"}', '{"rates":["1","2","3"]}')]
    t = T.ticks(T.viz_rates(_req(spark, rows)))
    assert t.columns == ["timestamp", "request", "symbol", "rate", "date_str"]
    r = t.collect()[0]
    assert r["request"] == "0" and r["date_str"] == "20210501100000"
    top = T.latest_rates(t, k=2).collect()
    assert [x["symbol"] for x in top] == ["C", "B"]
    assert T.latest_rates(t, k=5, symbol="A").count() == 1
