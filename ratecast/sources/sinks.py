"""Table sinks: replace, append, JSON records and chunks, all as Spark writers.

Paths live under the session's shared folder (``spark.checkpoint.dir``), so
on a cluster every executor writes to storage the others can read.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.session import shared_dir, tables_dir


def table_dir(spark: SparkSession, name: str, fresh: bool = False) -> str:
    """Folder of a written table under the shared folder; ``fresh`` gives a new unique one."""
    suffix = f"-{uuid.uuid4().hex[:12]}" if fresh else ""
    return f"{tables_dir(spark)}/{name}{suffix}"


def _file_system(spark: SparkSession, path: str):
    """Hadoop path, its file system and configuration."""
    p, conf = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsparkSession.sessionState().newHadoopConf()
    return p, p.getFileSystem(conf), conf


#: File of a replaced table's folder that names the version readers see.
CURRENT = "_current"


def _swap_current(spark: SparkSession, path: str, version: str) -> None:
    """Point readers to ``version`` by one rename, which is atomic on file systems that have it."""
    target, fs, conf = _file_system(spark, f"{path}/{CURRENT}")
    written = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{CURRENT}-{version}")
    out = fs.create(written, True)
    out.write(bytearray(version.encode()))
    out.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(written, target, options)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version that readers of a replaced table see; None if it was never written."""
    p, fs, _ = _file_system(spark, f"{path}/{CURRENT}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table as last replaced, pinned to that version: a later replace does not change what this frame reads."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{path}/{version}")


def _remove_old(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the ``keep`` newest versions (and what failed writes left); the current one always stays."""
    p, fs, _ = _file_system(spark, path)
    current = current_version(spark, path)
    versions = sorted(x.getPath().getName() for x in fs.listStatus(p) if x.getPath().getName().startswith("v-"))
    versions = [v for v in versions if v <= current]
    for v in versions[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{v}"), True)


def sink_replace(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 cluster_by: str | None = None, sort_within: list | None = None, keep: int = 2,
                 tasks: int | None = None) -> DataFrame:
    """``CREATE OR REPLACE TABLE ... AS SELECT`` (K1, K2): readers see the old table or the new one, never a part.

    The rows go to a new version folder; only when all are written, a file that names the version is
    swapped in by a rename. A job that fails leaves the old table as it was. ``read_current`` reads the table; frames already
    reading a version go on with it while it is among the ``keep`` newest. Returns the new version's rows.

    No global ``ORDER BY`` before the write: ordering a whole table costs a
    range shuffle and is not kept by readers anyway. A layout is given instead
    by ``cluster_by`` (hash-partition on a key, e.g. ``symbol``, over ``tasks`` files if given) and
    ``sort_within`` (order inside each file), as for the interpolated table's
    ``symbol, tumble DESC`` (O2).
    """
    spark = df.sparkSession
    if cluster_by:
        df = df.repartition(tasks, cluster_by) if tasks else df.repartition(cluster_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{version}")
    _swap_current(spark, path, version)
    _remove_old(spark, path, keep)
    return spark.read.parquet(f"{path}/{version}")


def sink_bucketed(df: DataFrame, path: str, key: str, sort_within: list[str], buckets: int, name: str | None = None) -> DataFrame:
    """Write the rows dealt into ``buckets`` files by a hash of ``key``, sorted in each, as a table that remembers it.

    Joins and aggregates on ``key`` between tables with the same number of buckets need no exchange; those on ``key`` and
    more neither, if the session sets ``spark.sql.requireAllClusterKeysForCoPartition`` to false (else they shuffle, with the same result). The table is known to the application's catalog under a new name (or ``name``); its files are in ``path``.
    """
    name = name or f"bucketed_{uuid.uuid4().hex[:16]}"
    # one task writes a bucket, so a bucket is one file
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*sort_within).option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def sink_append(df: DataFrame, path: str) -> DataFrame:
    """``WRITE_APPEND`` (K3): add the rows to the table; running twice doubles them."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def to_json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row (K4), as a single ``value`` column."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def sink_json_records(df: DataFrame, path: str) -> DataFrame:
    """Write rows as JSON lines and read them back with the same schema (K4).

    Writers stream the records partition by partition; nothing passes through
    the driver.
    """
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


#: Bytes of a response chunk at most.
CHUNK_BYTES = 2 ** 20
#: Rows of a range of the document that a task takes, about.
RANGE_ROWS = 2 ** 18


def json_chunks(df: DataFrame, order_by: list[str], limit: int = CHUNK_BYTES) -> DataFrame:
    """The rows as one JSON document ``[{...},{...}]`` in pieces of at most ``limit`` bytes (K4): ``chunk, text``.

    Chunks in order, end to end, are the document; a chunk holds whole records, unless a record takes more
    than a quarter of the limit: such a record is cut. Rows are counted (``df`` should be cheap to read), range-partitioned by
    ``order_by`` into ranges that don't grow with them, and sorted; a
    running sum of bytes within each partition, plus the totals of the partitions before (one row a partition),
    gives every record its place in the document, and its place gives its chunk. No task holds more than its partition
    and one chunk, and nothing passes through the driver. An empty frame is the document ``[]``.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    rows = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    rows = rows.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"), F.monotonically_increasing_id().alias("id"))
    rows = materialize(rows)  # ids hold the partition and the order within it: fixed from here on
    ends = rows.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    text = F.concat(F.when(F.col("id") == lo, F.lit("[")).otherwise(F.lit(",")), F.col("record"), F.when(F.col("id") == hi, F.lit("]")).otherwise(F.lit("")))
    # characters take four bytes at most
    width = max(1, limit // 16)
    cuts = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / width).cast("int"))
    whole = F.octet_length("text") <= limit // 4
    rows = rows.select("id", text.alias("text"))
    rows = rows.select("id", F.posexplode(F.when(whole, F.array("text")).otherwise(
        F.transform(cuts, lambda i: F.substring(F.col("text"), i * width + 1, F.lit(width))))).alias("k", "text"))
    empty = ends.where("n = 0").select(F.lit(0).cast("long").alias("id"), F.lit(0).alias("k"), F.lit("[]").alias("text"))
    rows = rows.unionByName(empty).select("*", F.shiftright("id", 33).alias("part"), F.octet_length("text").cast("long").alias("size"))
    totals = rows.groupBy("part").agg(F.sum("size").alias("size"))
    before = totals.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    running = F.sum("size").over(Window.partitionBy("part").orderBy("id", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("end", running).join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("end") - F.col("size"))
    # a piece is at most a quarter of the limit, so what begins within three quarters ends within the limit
    chunk = F.floor(F.col("start") / max(1, limit - limit // 4)).cast("long")
    return (placed.groupBy(chunk.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
            .select("chunk", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")))


def records_of_chunks(chunks: DataFrame, schema) -> DataFrame:
    """The records of chunks that hold whole records, parsed back."""
    inner = F.concat(F.lit("["), F.regexp_replace("text", r"^[\[,]|\]$", ""), F.lit("]"))
    return chunks.select(F.inline(F.from_json(inner, T.ArrayType(schema))))


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a stage's output with a reliable checkpoint.

    The data goes to the session's shared folder (``spark.checkpoint.dir``), so
    a lost executor does not force a recompute from the ticks, and scalar
    subqueries over the result (bounds, holdout cut, forecast end) scan this
    stored result instead of re-planning everything upstream. The checkpoint
    keeps the frame's partitioning, so per-symbol windows downstream add no
    exchange.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
