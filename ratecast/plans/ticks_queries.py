"""Queries of the JSON-to-ticks path (visualisation and simulated stream / validation tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.functions import ieee_divide, json_scalar
from ratecast.operators import ticks as T
from ratecast.plans import sql as S
from ratecast.plans.registry import register
from ratecast.sources.fixtures import oracle_requests
from ratecast.sources.sinks import sink_replace, table_dir
from ratecast.sources.slices import holdout_slice, replay_slice
from ratecast.sources.tables import read_table

# Fixed parameters of the replayed slices over the order dates (1995-2001).
STREAM_START = "1998-01-01"
AS_OF = "2000-01-01"
STREAM_LAG_DAYS = 90        # stream slice ends at as_of - 90 days
VALIDATION_DAYS = (90, 85)  # validation slice [as_of - 90 days, as_of - 85 days)
ORDER_KEY = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


_STORED: dict[tuple[str, str], DataFrame] = {}


def _requests(spark, sf) -> DataFrame:
    """The nested request table, written once per application and input and then scanned."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        _STORED[key] = sink_replace(oracle_requests(spark, sf), table_dir(spark, "oracle_requests", fresh=True))
    return _STORED[key]


def _viz(spark, sf):
    return T.viz_rates(_requests(spark, sf))


@register("scan_oracle_requests",
          S.with_(S.REQ_LINES, S.REQ_KEPT,
                  "req AS (SELECT o_orderkey, any_value(o_orderdate) AS o_orderdate, "
                  f"string_agg('\"S' || CAST(l_suppkey AS VARCHAR) || '\"', ',' ORDER BY {ORDER_KEY}) AS syms, "
                  f"list(CAST(l_extendedprice AS VARCHAR) ORDER BY {ORDER_KEY}) AS rates FROM req_kept GROUP BY o_orderkey)") +
          f"SELECT o_orderdate AS block_timestamp, {S.tumble('o_orderdate', 3600)} AS block_timestamp_truncated, "
          "o_orderkey AS oracle_request_id, "
          "'{\"symbols\":[' || syms || '],\"multiplier\":\"' || CASE WHEN o_orderkey % 13 = 0 THEN '0' ELSE '100' END || '\"}' AS calldata, "
          "'{\"rates\":[' || coalesce(array_to_string(list_transform("
          "CASE WHEN o_orderkey % 7 = 0 THEN list_slice(rates, 1, len(rates) - 1) ELSE rates END, "
          "lambda x: '\"' || x || '\"'), ','), '') || ']}' AS result FROM req")
def q_scan_oracle_requests(spark, sf):
    return T.scan_oracle_requests(_requests(spark, sf))


@register("parse_oracle_json",
          S.with_(S.REQ_LINES, S.REQ_KEPT,
                  "req AS (SELECT o_orderkey, any_value(o_orderdate) AS o_orderdate, "
                  f"list('S' || CAST(l_suppkey AS VARCHAR) ORDER BY {ORDER_KEY}) AS symbols, "
                  f"list(l_extendedprice ORDER BY {ORDER_KEY}) AS rates FROM req_kept GROUP BY o_orderkey)") +
          "SELECT symbols, CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE 100.0 END AS multiplier, "
          "CASE WHEN o_orderkey % 7 = 0 THEN list_slice(rates, 1, len(rates) - 1) ELSE rates END AS rates, "
          f"o_orderdate AS block_timestamp, {S.tumble('o_orderdate', 3600)} AS block_timestamp_truncated, "
          "o_orderkey AS oracle_request_id FROM req")
def q_parse_oracle_json(spark, sf):
    return T.parse_oracle_json(T.scan_oracle_requests(_requests(spark, sf)))


@register("unnest_rates",
          S.with_(S.REQ_LINES, S.REQ_KEPT) +
          f"SELECT o_orderdate AS block_timestamp, {S.tumble('o_orderdate', 3600)} AS block_timestamp_truncated, "
          "o_orderkey AS oracle_request_id, CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE 100.0 END AS multiplier, "
          "'S' || CAST(l_suppkey AS VARCHAR) AS symbol, l_extendedprice AS rate FROM req_kept WHERE o_orderkey % 7 <> 0")
def q_unnest_rates(spark, sf):
    return T.unnest_rates(T.parse_oracle_json(T.scan_oracle_requests(_requests(spark, sf))))


@register("viz_rates", S.with_(S.viz_cte()) + "SELECT * FROM viz ORDER BY block_timestamp_truncated DESC")
def q_viz_rates(spark, sf):
    return T.viz_rates(_requests(spark, sf), ordered=True)


@register("ticks", S.with_(S.viz_cte(), S.req_ticks_cte()) + "SELECT * FROM rticks")
def q_ticks(spark, sf):
    return T.ticks(_viz(spark, sf))


@register("latest_rates",
          S.with_(S.viz_cte(), S.req_ticks_cte()) +
          "SELECT * FROM rticks ORDER BY \"timestamp\" DESC, request DESC, symbol DESC, rate DESC LIMIT 10")
def q_latest_rates(spark, sf):
    return T.latest_rates(T.ticks(_viz(spark, sf)), k=10)


@register("symbol_filter", S.with_(S.viz_cte(), S.req_ticks_cte()) + "SELECT * FROM rticks WHERE symbol = 'S7'")
def q_symbol_filter(spark, sf):
    t = T.ticks(_viz(spark, sf))
    return t.filter(F.col("symbol") == "S7")


@register("simulate_stream",
          S.with_(S.viz_cte(), S.req_ticks_cte(
              where=f"block_timestamp_truncated >= TIMESTAMP '{STREAM_START}' AND block_timestamp_truncated < "
                    f"CAST(DATE '{AS_OF}' - INTERVAL {STREAM_LAG_DAYS} DAY AS TIMESTAMP)")) + "SELECT * FROM rticks")
def q_simulate_stream(spark, sf):
    import datetime as dt
    end = dt.date.fromisoformat(AS_OF) - dt.timedelta(days=STREAM_LAG_DAYS)
    out = replay_slice(T.ticks(_viz(spark, sf)), STREAM_START, end)
    return sink_replace(out, table_dir(spark, "simulated_stream", fresh=True))


@register("replay_slice",
          S.with_(S.ticks_cte()) +
          "SELECT * FROM ticks WHERE \"timestamp\" >= TIMESTAMP '2024-01-21' AND \"timestamp\" < TIMESTAMP '2024-01-26'")
def q_replay_slice(spark, sf):
    from ratecast.sources.fixtures import read_ticks
    return replay_slice(read_ticks(spark, sf), "2024-01-21", "2024-01-26")


@register("simulate_validation",
          S.with_(S.viz_cte(), S.req_ticks_cte(
              where=f"block_timestamp_truncated >= CAST(DATE '{AS_OF}' - INTERVAL {VALIDATION_DAYS[0]} DAY AS TIMESTAMP) "
                    f"AND block_timestamp_truncated < CAST(DATE '{AS_OF}' - INTERVAL {VALIDATION_DAYS[1]} DAY AS TIMESTAMP)"))
          + "SELECT * FROM rticks")
def q_simulate_validation(spark, sf):
    out = holdout_slice(T.ticks(_viz(spark, sf)), AS_OF, *VALIDATION_DAYS)
    return sink_replace(out, table_dir(spark, "simulated_validation", fresh=True))


@register("holdout_slice",
          S.with_(S.ticks_cte()) +
          "SELECT * FROM ticks WHERE \"timestamp\" >= TIMESTAMP '2024-01-26' - INTERVAL 5 DAY "
          "AND \"timestamp\" < TIMESTAMP '2024-01-26'")
def q_holdout_slice(spark, sf):
    from ratecast.sources.fixtures import read_ticks
    return holdout_slice(read_ticks(spark, sf), "2024-01-26", 5, 0)


@register("json_scalar", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def q_json_scalar(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "props"])
    return ev.select("event_id", json_scalar("props", "$.k").alias("k"))


@register("ieee_divide",
          f"SELECT event_id, {S.ieee_div('value - 100', 'event_id % 3')} AS q, "
          f"{S.ieee_div('floor(value) - floor(value)', 'event_id % 3')} AS q0 FROM events")
def q_ieee_divide(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "value"])
    return ev.select("event_id", ieee_divide(F.col("value") - 100, F.col("event_id") % 3).alias("q"),
                     ieee_divide(F.floor("value") - F.floor("value"), F.col("event_id") % 3).alias("q0"))
