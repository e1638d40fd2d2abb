"""Plan shape: no Python in SQL-expressible keys, no unbounded-following frame,
pruned scans, and no exchange between the grid join and the neighbour windows."""

import re

import pytest

from ratecast.plans import oracle_sql, queries

SF = "/root/testdata/sf0.001"
#: Models whose few numbers a series are solved by a vectorised function over a batch of series, or which smooth a series in arrays.
BATCH_SOLVED = {"forecast_changepoint", "changepoint_model", "decompose_local"}
SIDE_EFFECT = {"scan_training", "model_table", "sink_replace", "sink_append", "sink_json_records", "simulate_stream", "simulate_validation"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if not n.startswith("stream") and n not in SIDE_EFFECT | BATCH_SOLVED))
def test_no_python_and_no_following_frame(spark, name):
    df = queries()[name](spark, SF)
    plan = _plan(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name} runs Python: {bad}"
    # a frame that starts after the current row is aggregated again for every row
    late = re.compile(r"specifiedwindowframe\(\w+, (?!unboundedpreceding|currentrow|-)[^,]*, unboundedfollowing")
    assert not late.search(plan)
    assert late.search("specifiedwindowframe(RowFrame, 1, unboundedfollowing$())")


def test_interpolation_plan_shape(spark):
    plan = _plan(queries()["interpolate_hourly_users"](spark, SF))
    # gap filling needs no grid join, and reads the stored hourly table, not the ticks
    assert "Join" not in plan and "FileScan" not in plan and "Scan ExistingRDD" in plan
    # one exchange of the hourly rows and one window (lag/lead) over the known hours
    assert plan.count("Window [") == 1 and plan.count("Exchange hashpartitioning(symbol") == 1


def test_hourly_mean_plan_shape(spark):
    df = queries()["hourly_mean"](spark, SF)
    plan = _plan(df)
    # ticks are pre-aggregated before the only shuffle, and the scan reads 3 columns
    assert "partial_avg" in plan and plan.count("Exchange") == 1
    assert sorted(re.search(r"ReadSchema: struct<([^>]*)>", plan)[1].split(",")) == ["event_type:string", "ts:timestamp_ntz", "value:double"]


def test_json_is_parsed_once_per_document(spark):
    plan = _plan(queries()["unnest_rates"](spark, SF))
    assert len(re.findall(r"try_parse_json|parse_json|parseJson", plan)) <= 2  # calldata and result


def test_library_has_no_driver_side_actions():
    """Operators return DataFrames; nothing in the library pulls rows to the driver."""
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parent.parent / "ratecast"
    bad = re.compile(r"\.(collect|toPandas|toLocalIterator|take|head|first)\(")
    hits = [f"{p.name}:{i}" for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts  # bounded ones are documented there
            for i, line in enumerate(p.read_text().splitlines(), 1) if bad.search(line)]
    assert hits == []
