"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from ratecast.plans import oracle_sql, queries
from tools.check_oracle import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = con.execute(sql).fetchdf()
    err = compare(got, want)
    assert err is None, err
