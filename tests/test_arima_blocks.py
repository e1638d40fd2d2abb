"""Series fitted in blocks: the same models as one by one, whole series in every block, and no Python call a series for each step."""

import time

import numpy as np
import pyarrow as pa
import pytest

from ratecast.operators import arima as A
from ratecast.operators import arima_blocks as AB
from ratecast.operators import series_blocks as SB
from ratecast.sources.sinks import sink_bucketed
from test_arima import PLANTED, frame, simulate

TRIED = [(1, 0), (2, 1), (0, 2)]


def planted(rng, many, rows):
    orders = list(PLANTED)
    return [np.diff(simulate(rng, rows + o[1], *PLANTED[o], o[1]), n=o[1]) + 5 * (i % 2) for i, o in ((i, orders[i % len(orders)]) for i in range(many))]


def close(got, want):
    return got[:2] == want[:2] and np.allclose(got[2], want[2], rtol=1e-6, atol=1e-6) and abs(got[3] - want[3]) <= 1e-6 * abs(want[3])


def test_models_of_a_block_are_those_of_single_series():
    rng = np.random.default_rng(21)
    series = [w for rows in (60, 75, 300, 310) for w in planted(rng, 12, rows)]
    series += [np.zeros(80), np.full(80, 7.0), np.arange(80.0), np.array([1.0, 2.0]), np.empty(0), rng.normal(size=30)]
    tried = [TRIED[:i % 4] for i in range(len(series))]
    got = A.refined_all(series, tried)
    assert all(close(g, A.refined(w, c)) for g, w, c in zip(got, series, tried))


def test_only_odd_series_are_fitted_one_by_one(monkeypatch):
    series = planted(np.random.default_rng(22), 40, 200)
    alone = []
    monkeypatch.setattr(A, "refined", lambda w, c: alone.append(w) or (0, 0, np.zeros(1), 0.0))
    A.refined_all([*series, np.zeros(200)], [TRIED] * 41)
    assert len(alone) <= 3 and any(not w.any() for w in alone)


def test_a_block_takes_less_time_than_its_series():
    series = planted(np.random.default_rng(23), 150, 400)

    def seconds(f):
        start = time.process_time()
        f()
        return time.process_time() - start

    A.refined_all(series[:10], [TRIED] * 10)
    alone = seconds(lambda: [A.refined(w, TRIED) for w in series[:50]]) / 50
    assert seconds(lambda: A.refined_all(series, [TRIED] * 150)) / 150 < 0.7 * alone


def test_recursion_by_stretches():
    rng = np.random.default_rng(24)
    for rows in (1, 5, 24, 25, 100):
        for theta in (np.empty((0, 3)), np.array([[0.5, -0.9, 0.99]]), np.array([[0.4, 0.1, -0.3], [0.2, 0.0, 0.4], [0.1, 0.5, -0.2]])):
            x = rng.normal(size=(rows, 2, 3))
            want = x.copy()
            for t in range(rows):
                for j in range(min(t, len(theta))):
                    want[t] -= theta[j] * want[t - 1 - j]
            assert np.allclose(AB.filtered(x, theta), want, atol=1e-9)


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_blocks_hold_whole_series(monkeypatch, rows):
    monkeypatch.setattr(SB, "BLOCK_ROWS", rows)
    lengths = [3, 1, 20, 2, 9, 1]
    place = np.concatenate([np.arange(1, n + 1) for n in lengths])
    table = pa.table({"place": pa.array(place, pa.int32()), "v": pa.array(np.arange(len(place)))})
    for size in (1, 4, 100):
        found = [(b.column("v").to_pylist(), np.diff(cuts).tolist()) for b, cuts in SB.blocks(iter(table.to_batches(size)))]
        assert sum((v for v, _ in found), []) == list(range(len(place))) and sum((n for _, n in found), []) == lengths
        assert len(found) <= len(lengths) and (size > 1 or len(found) == {1: 6, 1000: 1}.get(rows, len(found)))


def test_no_python_group_a_series_and_none_is_cut(spark, tmp_path, capsys):
    rng = np.random.default_rng(25)
    series = {f"s{i}": simulate(rng, 120, (0.6,)) for i in range(60)}
    train = sink_bucketed(frame(spark, series), str(tmp_path / "t"), "symbol", ["symbol", "ds"], 20)
    model = A.arima_model(train, 20)
    got = {r.symbol: r for r in model.collect()}
    want = {r.symbol: r for r in A.arima_model(frame(spark, series)).collect()}
    assert model.count() == len(series) and got.keys() == series.keys()
    assert all(got[k][1:4] == want[k][1:4] and abs(got[k].sigma2 - want[k].sigma2) < 1e-9 for k in series)
    model.explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan


def test_null_symbol_and_gaps(spark):
    rng = np.random.default_rng(26)
    y = list(simulate(rng, 100, (0.6,)))
    rows = frame(spark, {"a": y, "b": [None] * 30, "c": [None, *y[:50], None, float("inf"), *y[50:]]})
    odd = frame(spark, {"d": y}).selectExpr("CAST(NULL AS STRING) AS symbol", "ds", "y")
    got = {r.symbol: r for r in A.arima_model(rows.unionByName(odd)).collect()}
    assert got.keys() == {"a", "b", "c", None}
    assert (got["b"].p, got["b"].d, got["b"].q, got["b"].sigma2) == (0, 0, 0, 0.0)
    assert abs(got[None].sigma2 - got["a"].sigma2) < 0.2 * got["a"].sigma2
