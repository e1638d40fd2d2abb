"""Parquet table scans.

Column lists are explicit, so the scan's ``ReadSchema`` holds only what the
plan needs; filters written after the read are pushed into the scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def scan_rates(df: DataFrame) -> DataFrame:
    """Full scan of a flat tick table with an explicit projection."""
    return df.select("timestamp", "request", "symbol", "rate", "date_str")
