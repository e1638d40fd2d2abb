"""The scheduled job's tables: tasks follow the rows, dense rows are not shuffled, a query writes only what it reads."""

import pytest

from ratecast.operators import gridding as G
from ratecast.plans import model_queries as Q
from ratecast.plans import queries
from ratecast.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture
def fresh(monkeypatch):
    """Tables of this test alone, with a task for every 500 dense rows."""
    monkeypatch.setattr(Q._Tables, "written", {})
    monkeypatch.setattr(G, "TASK_ROWS", 500)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def written(spark):
    return set().union(*(t.__dict__ for t in Q._Tables.written.values()))


def test_tasks_follow_the_dense_rows(spark, fresh):
    st = Q._Stage(spark, SF)
    n = st.t5.count()
    assert st.tasks == -(-n // 500) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert st.t5.rdd.getNumPartitions() == st.train_ar.rdd.getNumPartitions() == st.tasks


@pytest.mark.parametrize("name, unread", [("dashboard_hourly_arima", {"forecast", "scored_seasonal", "split"}), ("serve_max", {"params", "explained", "scored_ar", "split"}),
                                          ("dashboard_hourly_split", {"params", "explained", "scored_ar", "scored_seasonal"})])
def test_only_what_is_read_is_written(spark, fresh, name, unread):
    queries()[name](spark, SF).count()
    assert not unread & written(spark)


@pytest.mark.parametrize("name", ["dashboard_hourly_arima", "dashboard_hourly_split", "serve_max", "forecast_rmse_bucketed", "forecast_vs_actual_bucketed", "json_chunks"])
def test_same_rows_with_more_tasks(spark, fresh, monkeypatch, name):
    many = rows(queries()[name](spark, SF))
    monkeypatch.setattr(Q._Tables, "written", {})
    monkeypatch.setattr(G, "TASK_ROWS", 2 ** 18)
    assert many == rows(queries()[name](spark, SF)) != []


@pytest.mark.parametrize("name", ["forecast_vs_actual_bucketed", "forecast_rmse_bucketed"])
def test_bucketed_joins_need_no_exchange_by_default(spark, fresh, name):
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    df = queries()[name](spark, SF)
    assert spark.conf.get(setting) == "true"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan  # bounds are single rows


def test_ranges_of_a_document_follow_its_rows(spark, monkeypatch):
    parts = []
    monkeypatch.setattr(sinks, "RANGE_ROWS", 50)
    monkeypatch.setattr(sinks, "materialize", lambda df, real=sinks.materialize: parts.append(df.rdd.getNumPartitions()) or real(df))
    df = spark.range(2000).selectExpr("id", "id % 7 AS x")
    text = "".join(r["text"] for r in sinks.json_chunks(df, ["id"], 4096).orderBy("chunk").collect())
    assert parts == [40] and text == "[" + ",".join(f'{{"id":{i},"x":{i % 7}}}' for i in range(2000)) + "]"


@pytest.mark.parametrize("name", ["changepoint_model", "forecast_changepoint_band", "forecast_changepoint"])
def test_the_trend_is_fitted_where_the_series_lie(spark, fresh, monkeypatch, name):
    seen = []
    fit = Q.C.fit_changepoints
    monkeypatch.setattr(Q.C, "fit_changepoints", lambda train, *a, **k: seen.append(train) or fit(train, *a, **k))
    queries()[name](spark, SF)
    plan = seen[0].groupBy("symbol").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
