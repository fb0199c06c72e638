"""Session defaults that the plans in this library are designed for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE coalesces small partitions and splits skewed joins, but never widens an aggregate's shuffle: see initial_partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state (one row per day and sender) outgrows the heap; keep it in RocksDB.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# What one task sorts in a shuffle that is sized by rows: some 200 MB of transfers.
ROWS_PER_TASK = 250_000


def build_session(app: str = "transferlens", master: str | None = None, initial_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS and ``conf``.

    ``initial_partitions`` is the width that adaptive shuffles start from before they coalesce; size it to the largest
    shuffle over what fits one task (about 100,000 for 10 TB). None leaves ``spark.sql.shuffle.partitions`` in charge.
    """
    if initial_partitions:
        conf = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial_partitions), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder, for staged tables.

    The cluster names the folder in ``spark.checkpoint.dir``; only where that is unset (tests on one
    machine) a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="transferlens-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` in as many partitions as ``rows`` rows fill, so that what a task sorts does not grow with the input.

    Where the session's own shuffles are as wide, they are left to adaptive execution. Both sides of a join take the same ``rows``.
    """
    wide = -(-rows // ROWS_PER_TASK)
    return df.repartition(wide, *keys) if wide > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lost executors cost no recomputation, and Spark knows its size."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
