"""Named queries over the given tables, each with an independent DuckDB oracle."""

from ratecast.plans.registry import oracle_sql, queries  # noqa: F401
