"""Session helpers: build a session for tests / bench, and find the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the library wants; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small local data is CPU-bound per row (JSON, windows): let AQE keep more, smaller partitions
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ratecast",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (the cluster builds its own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RATECAST_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    ``spark.checkpoint.dir`` of the session, else the folder already given with
    ``sparkContext.setCheckpointDir``. Where neither is set, a local master gets
    a fresh local folder (tests) and a cluster an error: a folder of the driver's
    own disk is not seen by the executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ratecast-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


#: Joins by (symbol, time) of frames that are dealt alike on ``symbol`` need no exchange where this is "false".
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Within it, writes of ``spark`` join frames that are dealt alike on ``symbol`` as they lie."""
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def co_partitioned_session(spark: SparkSession) -> SparkSession:
    """A session of the same application, tables and settings whose frames are always joined so; ``spark`` keeps its own setting."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set(CO_PARTITION, "false")
    return other


def tables_dir(spark: SparkSession) -> str:
    """Folder of this application's written intermediate tables, inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"


def drop_tables(spark: SparkSession, name: str = "") -> None:
    """Delete this application's intermediate tables (or one of them) from the shared folder."""
    base = tables_dir(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}" if name else base)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
