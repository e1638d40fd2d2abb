"""Replace that readers never see half done; bounded chunks of a JSON document; SQL functions."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ratecast.functions import interpolate_or_fill, linear_interpolate, tumble_interval
from ratecast.functions.sql_functions import register_functions
from ratecast.sources import sinks


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/table"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_failed_write_leaves_the_old_table(spark, path):
    sinks.sink_replace(spark.range(10), path)
    broken = spark.range(0, 1000, 1, 8).withColumn("id", F.when(F.col("id") == 900, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.sink_replace(broken, path)
    assert ids(sinks.read_current(spark, path)) == list(range(10))
    sinks.sink_replace(spark.range(3), path)
    assert ids(sinks.read_current(spark, path)) == [0, 1, 2]


def test_readers_stay_on_their_version(spark, path):
    sinks.sink_replace(spark.range(5), path)
    old = sinks.read_current(spark, path)
    new = sinks.sink_replace(spark.range(7), path)
    assert ids(old) == list(range(5)) and ids(new) == list(range(7)) == ids(sinks.read_current(spark, path))


def test_old_versions_are_removed(spark, path):
    for k in range(1, 5):
        sinks.sink_replace(spark.range(k), path, keep=2)
    versions = [x for x in os.listdir(path.removeprefix("file://")) if x.startswith("v-")]
    assert len(versions) == 2 and sinks.current_version(spark, path) == max(versions)


def test_a_replace_may_read_the_table_it_replaces(spark, path):
    sinks.sink_replace(spark.range(5), path)
    sinks.sink_replace(sinks.read_current(spark, path).select((F.col("id") * 2).alias("id")), path)
    assert ids(sinks.read_current(spark, path)) == [0, 2, 4, 6, 8]


def test_no_table_and_layout(spark, path):
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, path)
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    out = sinks.sink_replace(df, path, partition_by=["k"], sort_within=["id"])
    assert out.where("k = 1").count() == 33 and ids(out) == list(range(100))


@pytest.mark.parametrize("limit", [64, 200, 5000, 2 ** 20])
def test_chunks_are_the_document(spark, limit):
    rows = [(i, "é" * (i % 40) + ("z" * 900 if i % 97 == 0 else ""), float(i) if i % 5 else None) for i in range(700)]
    df = spark.createDataFrame(rows, "i long, s string, x double").repartition(6)
    chunks = sinks.json_chunks(df, ["i"], limit).orderBy("chunk").collect()
    assert all(0 < len(c.text.encode()) <= limit for c in chunks)
    parsed = json.loads("".join(c.text for c in chunks))
    assert [(r["i"], r["s"], r.get("x")) for r in parsed] == rows
    if limit == 2 ** 20:
        assert len(chunks) == 1
    if limit >= 5000:
        got = sinks.records_of_chunks(sinks.json_chunks(df, ["i"], limit), df.schema).collect()
        assert sorted(tuple(r) for r in got) == rows


def test_chunks_of_an_empty_frame(spark):
    assert [c.text for c in sinks.json_chunks(spark.range(0), ["id"]).collect()] == ["[]"]


def test_chunks_of_one_key(spark):
    """All rows with one key are one partition of the sort; the document is whole."""
    df = spark.range(300).withColumn("k", F.lit(1))
    text = "".join(c.text for c in sinks.json_chunks(df, ["k"], 400).orderBy("chunk").collect())
    assert sorted(r["id"] for r in json.loads(text)) == list(range(300))


def test_sql_functions_equal_the_column_functions(spark):
    register_functions(spark)
    t = dt.datetime
    rows = [(t(2024, 1, 1, 5, 30), 1.5, t(2024, 1, 1, 4), 1.0, t(2024, 1, 1, 9), 3.0), (t(1969, 12, 31, 23, 59, 59), None, t(1969, 12, 31), 2.0, t(1970, 1, 2), None),
            (t(2024, 3, 31, 2, 15), None, None, None, t(2024, 3, 31, 4), 1.0), (t(2024, 3, 31, 2, 15), None, t(2024, 3, 31, 1), 4.0, t(2024, 3, 31, 4), 1.0)]
    df = spark.createDataFrame(rows, "pos timestamp_ntz, v double, px timestamp_ntz, py double, nx timestamp_ntz, ny double")
    df = df.withColumns({"prv": F.when(F.col("px").isNotNull(), F.struct(F.col("px").alias("x"), F.col("py").alias("y"))),
                         "nxt": F.when(F.col("nx").isNotNull(), F.struct(F.col("nx").alias("x"), F.col("ny").alias("y")))})
    seconds = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.expr(f"epoch_second({c}.x)").alias("x"), F.col(f"{c}.y").alias("y")))
    df = df.withColumns({"p": F.expr("epoch_second(pos)"), "prv_s": seconds("prv"), "nxt_s": seconds("nxt")})
    got = df.select(F.expr("tumble_interval(pos, 3600L)").alias("a"), tumble_interval("pos", 3600).alias("b"),
                    F.expr("linear_interpolate(pos, prv, nxt)").alias("c"), linear_interpolate("p", "prv_s", "nxt_s").alias("d"),
                    F.expr("interpolate_ts_val_or_fill(v, pos, prv, nxt, 0.0D)").alias("e"), interpolate_or_fill("v", "p", "prv_s", "nxt_s", 0.0).alias("f")).collect()
    assert all(r.a == r.b and r.c == r.d and r.e == r.f for r in got)
    assert got[0].c == 1.6 and got[2].e == 0.0 and got[1].a == t(1970, 1, 1)
    hours = spark.sql("SELECT gen_ts_candidates(3600L, TIMESTAMP_NTZ '2024-01-01 00:10:00', TIMESTAMP_NTZ '2024-01-01 02:00:00') AS h").collect()[0].h
    assert hours == [t(2024, 1, 1, k) for k in range(3)]
