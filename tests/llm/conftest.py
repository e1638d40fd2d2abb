import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
#: Columns whose names clash with those that operators make.
CLASHING = ["text_key", "ord", "tag", "n", "score", "c", "c0", "host", "path", "rng", "guest", "starts", "wanted",
            "spans", "bucket", "label", "predicted", "held_out", "grp", "length", "piece", "rank", "own", "kind"]


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows, clashing=False):
        df = spark.createDataFrame(rows, DOCS)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        return df.repartition(3)

    return make


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, vocabulary, n))
