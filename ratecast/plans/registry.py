"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a query under ``name``; ``sql`` is its DuckDB oracle (None: rows-only)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def _load() -> None:
    # Importing the modules runs their @register decorators.
    from ratecast.plans import (  # noqa: F401
        gridding_queries,
        ticks_queries,
        model_queries,
        stream_queries,
    )


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
