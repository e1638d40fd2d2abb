"""Adapters from the given tables to the reference's input schemas.

* ticks ``(timestamp, request, symbol, rate, date_str)`` come from ``events``;
* ``oracle_requests`` (nested struct with JSON text) comes from
  ``orders`` joined with ``lineitem``, one request per order having lines.

Both are plain Spark jobs over whole tables, so their work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.functions import date_str, tumble_interval
from ratecast.sources.tables import read_table

# Fixed values of the oracle_requests fixture (see FIXTURES.md §3).
SCRIPT_ID_MODULUS = 5        # request.oracle_script_id = o_orderkey % 5; id 3 is the one parsed
NULL_CALLDATA_MODULUS = 11   # calldata is NULL when o_orderkey % 11 = 0
ZERO_MULTIPLIER_MODULUS = 13 # multiplier "0" when o_orderkey % 13 = 0, else "100"
SHORT_RATES_MODULUS = 7      # last rate dropped when o_orderkey % 7 = 0 (length mismatch)


def ticks_from_events(events: DataFrame, symbol: str = "event_type") -> DataFrame:
    """Tick table from ``events``: ``timestamp=ts``, ``request=event_id``, ``rate=value``."""
    return events.select(
        F.col("ts").alias("timestamp"),
        F.col("event_id").cast("string").alias("request"),
        F.col(symbol).cast("string").alias("symbol"),
        F.col("value").cast("double").alias("rate"),
        date_str("ts").alias("date_str"),
    )


def read_ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["ts", "event_id", symbol, "value"])
    return ticks_from_events(ev, symbol)


def oracle_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested request table built from ``orders`` ⋈ ``lineitem``.

    Lines of an order are ordered by (l_linenumber, l_partkey, l_suppkey,
    l_extendedprice); ``symbols[i] = 'S' || l_suppkey`` and
    ``rates[i] = l_extendedprice`` as JSON strings. The per-order arrays are
    the source format itself (one row per request), so they are bounded by the
    lines of one order.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    lines = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))).alias("lines"))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    j = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "inner")
    k = F.col("o_orderkey")
    symbols = F.transform("lines", lambda s: F.concat(F.lit("S"), s["l_suppkey"].cast("string")))
    rates = F.transform("lines", lambda s: s["l_extendedprice"].cast("string"))
    rates = F.when(k % SHORT_RATES_MODULUS == 0, F.slice(rates, 1, F.size(rates) - 1)).otherwise(rates)
    multiplier = F.when(k % ZERO_MULTIPLIER_MODULUS == 0, F.lit("0")).otherwise(F.lit("100"))
    calldata = F.when(k % NULL_CALLDATA_MODULUS == 0, F.lit(None).cast("string")).otherwise(
        F.to_json(F.struct(symbols.alias("symbols"), multiplier.alias("multiplier"))))
    result = F.to_json(F.struct(rates.alias("rates")))
    return j.select(
        F.col("o_orderdate").alias("block_timestamp"),
        tumble_interval("o_orderdate", 3600).alias("block_timestamp_truncated"),
        k.alias("oracle_request_id"),
        F.struct((k % SCRIPT_ID_MODULUS).alias("oracle_script_id")).alias("request"),
        F.struct(calldata.alias("calldata"), result.alias("result")).alias("decoded_result"),
    )
