"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import importlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.sources.sinks import table_dir
from ratecast.sources.tables import read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ``documents``."""
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, a lost executor loses nothing."""
    path = table_dir(df.sparkSession, name, fresh=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a list up to which it is broadcast; a longer one is joined by shuffling.
BROADCAST_ROWS = 500_000


def sized(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it was counted to be short; ``df`` should be stored or cheap."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def keyed(docs: DataFrame, *carry: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty), ``text_key`` (a hash of the text) and the columns to carry along.

    Rows are told apart by id and text: equal rows are one document, one id
    with two texts is two. Columns not named are left out, so clashing names
    cannot matter.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_key"), *carry)


def join_by_key(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on (doc_id, text_key), null ids equal; the key columns of ``a`` stay."""
    b = b.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return a.join(b, on, how).drop("_id", "_key")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which a worker gives the memory it no longer uses back to the system: workers are used again by later stages."""

    def then_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim is not None:
            trim(0)

    return then_release


def tokenizer_path(name: str) -> str:
    """File of a public tokenizer, found on the machine that asks."""
    return importlib.import_module("public_tokenizers").path(name)
