"""The queries that SQL can express, against DuckDB over the same tables."""

import duckdb
import pytest

from ratecast.llm import queries
from tools.check_oracle import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.queries()[name](spark, SF).toPandas()
    assert compare(got, con.execute(queries.oracle_sql()[name]).fetchdf()) is None and len(got)
