"""The time-bucket and interpolation functions as SQL functions of a session.

``register_functions(spark)`` creates temporary functions whose bodies are SQL expressions, so
Catalyst inlines them: no Python runs, and text that calls them is optimised like any other query.
Candidates are an array per key, exploded by the caller: Spark takes no generator that depends on a
table function's arguments from an outer row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _seconds(x: str) -> str:
    """Whole seconds since 1970 of a timestamp."""
    return f"CAST(floor(CAST(CAST({x} - {EPOCH} AS INTERVAL SECOND) AS DECIMAL(20, 6))) AS BIGINT)"


def _bucket(x: str) -> str:
    return f"({_seconds(x)} DIV tumble_seconds) * tumble_seconds"


POINT = "STRUCT<x: TIMESTAMP_NTZ, y: DOUBLE>"

FUNCTIONS = {
    "epoch_second": f"(val TIMESTAMP_NTZ) RETURNS BIGINT RETURN {_seconds('val')}",
    # truncates toward zero, as SQL DIV does
    "tumble_interval": f"(val TIMESTAMP_NTZ, tumble_seconds BIGINT) RETURNS TIMESTAMP_NTZ RETURN timestampadd(SECOND, {_bucket('val')}, {EPOCH})",
    # of one series: a row and an explode for each key, never one array of all keys
    "gen_ts_candidates": ("(tumble_seconds BIGINT, min_ts TIMESTAMP_NTZ, max_ts TIMESTAMP_NTZ) RETURNS ARRAY<TIMESTAMP_NTZ> RETURN "
                          f"transform(sequence({_bucket('min_ts')}, {_bucket('max_ts')}, tumble_seconds), p -> timestampadd(SECOND, p, {EPOCH}))"),
    "linear_interpolate": (f"(pos TIMESTAMP_NTZ, prev {POINT}, next {POINT}) RETURNS DOUBLE RETURN CASE WHEN prev IS NULL OR next IS NULL THEN NULL ELSE "
                           "(next.y - prev.y) / CAST(epoch_second(next.x) - epoch_second(prev.x) AS DOUBLE) * CAST(epoch_second(pos) - epoch_second(prev.x) AS DOUBLE) + prev.y END"),
    "interpolate_ts_val_or_fill": (f"(value DOUBLE, pos TIMESTAMP_NTZ, prev {POINT}, next {POINT}, def DOUBLE) RETURNS DOUBLE RETURN "
                                   "CASE WHEN value IS NOT NULL THEN value WHEN prev IS NULL OR next IS NULL THEN def ELSE linear_interpolate(pos, prev, next) END"),
}


def register_functions(spark: SparkSession) -> None:
    """Create (or replace) the functions in the session."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
