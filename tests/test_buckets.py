"""Bucketed tables: joins and aggregates on their key need no exchange."""

import re

import pytest

from ratecast.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["forecast_vs_actual_bucketed", "forecast_rmse_bucketed"])
def test_no_exchange_between_the_tables_and_the_result(spark, name):
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        df = queries()[name](spark, SF)
        check(df)
    finally:
        spark.conf.set(setting, old)


def check(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and len(re.findall(r"Bucketed: true", plan)) == 2
    main = re.split(r"Subquer", plan)[0]  # scalar bounds are subqueries of their own
    assert "Exchange" not in main, main
    assert df.count() > 0
