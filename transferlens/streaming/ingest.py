"""Incremental ingest of landed log files into the transfers table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from transferlens.schema import DEFAULT_CHAIN, RAW_LOGS, check_chain
from transferlens.session import spread
from transferlens.sources.raw_logs import parse_logs, read_blocks, sorted_out, with_block_time
from transferlens.sources import files
from transferlens.sources.transfers import IDENTITY, landed_or_none, write_transfers
from transferlens.streaming.totals import VALUE, keep_totals, measures


def not_yet_landed(batch: DataFrame, landed: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` with a new identity (chain, block, log), each once.

    Only the identity columns of the days and blocks that the batch spans are read from the table: both
    ranges reach the scan, as partition filters and as row-group filters.
    """
    day = F.to_date("block_timestamp")
    first_block, last_block, first_day, last_day, rows = batch.agg(
        F.min("block_number"), F.max("block_number"), F.min(day), F.max(day), F.count(F.lit(1))
    ).first()
    if landed is None or first_block is None:
        return spread(batch, rows, *IDENTITY).dropDuplicates(IDENTITY)
    known = landed.filter(
        F.col("block_number").between(first_block, last_block) & F.col("block_date").between(first_day, last_day)
    ).select(*IDENTITY)
    # Both sides are dealt by the identity once, which the duplicates and the join then share.
    rows = max(rows, known.count())
    fresh = spread(batch, rows, *IDENTITY).dropDuplicates(IDENTITY)
    return fresh.join(spread(known, rows, *IDENTITY), IDENTITY, "left_anti")


def waiting_logs(spark: SparkSession, path: str) -> DataFrame | None:
    """Parsed logs whose block had not landed, by the ``batch`` that left them; None if there never were any.

    A log that has landed since may still be among them.
    """
    parsed = parse_logs(spark.createDataFrame([], RAW_LOGS)).schema
    try:
        return spark.read.schema(T.StructType([*parsed.fields, T.StructField("batch", T.LongType())])).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def ingest_stream(
    spark: SparkSession,
    logs_path: str,
    blocks_path: str,
    table_path: str,
    checkpoint: str,
    *,
    chain_id: int = DEFAULT_CHAIN,
    fmt: str = "parquet",
    max_files: int = 1000,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Decode all log files that arrived since the last run, then stop.

    The checkpoint remembers which files were read. A batch that is replayed after a failure, or a log that
    is delivered again in a later file however late, finds its identity in the table and is not written
    twice; so there is no watermark beyond which duplicates would slip through. ``max_files`` sizes a
    batch; all files are read.

    A log whose block has not landed waits in a folder inside the checkpoint. It is tried again at the start of each run and
    with each batch, and lands once its block is there. With ``rejects_path``, logs that do not decode are written
    there with their reason, by batch; a replay overwrites its batch. Totals over all runs are kept with the checkpoint
    (see ``totals``); ``observedMetrics`` of the query progress carry those of a batch, the value as exact slice sums.
    """
    check_chain(chain_id)
    waiting_path = f"{checkpoint}/waiting"
    logs = spark.readStream.schema(RAW_LOGS).format(fmt).option("maxFilesPerTrigger", max_files).load(logs_path)
    observed = sorted_out(logs).withColumnRenamed("value", VALUE).observe("ingest", *measures())
    observed = observed if rejects_path else observed.drop("reject")

    def stage(df: DataFrame, name: str) -> DataFrame:
        """Written and read back; the next batch takes its place. A cache would hold wide rows in memory and leave Spark without their number."""
        path = f"{checkpoint}/staged/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def land(session: SparkSession, parsed: DataFrame, waiting_to: str | None) -> None:
        first, last, rows = parsed.agg(F.min("block_number"), F.max("block_number"), F.count(F.lit(1))).first()
        blocks = read_blocks(session, blocks_path, fmt).filter(F.col("block_number").between(first, last))
        rows = max(rows, blocks.count())
        both = (spread(df, rows, "block_number") for df in (parsed, blocks))
        timed = stage(with_block_time(*both, chain_id, F.lit(None).cast("timestamp")), "timed")
        known = timed.filter(F.col("block_timestamp").isNotNull())
        write_transfers(not_yet_landed(known, landed_or_none(session, table_path)), table_path)
        if waiting_to:
            unknown = timed.filter(F.col("block_timestamp").isNull())
            unknown = spread(unknown, unknown.count(), *IDENTITY).dropDuplicates(IDENTITY)
            unknown.select(*parsed.columns).write.mode("overwrite").parquet(waiting_to)

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch = stage(batch, "logs")  # read, decoded and observed once
        parsed = batch.filter(F.col(VALUE).isNotNull()).withColumnRenamed(VALUE, "value").drop("reject")
        waiting = waiting_logs(session, waiting_path)
        if waiting is not None:
            parsed = parsed.unionByName(waiting.filter(F.col("batch") < batch_id).drop("batch"))
        land(session, parsed, f"{waiting_path}/batch={batch_id}")
        if rejects_path:
            rejects = batch.filter(F.col("reject").isNotNull()).select("reject.*")
            rejects.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        keep_totals(batch, checkpoint, batch_id)
        files.delete(session, f"{checkpoint}/staged")
        # A replay of this batch needs what the batch before it left; what is older has been carried on.
        files.delete(session, f"{waiting_path}/batch={batch_id - 2}")

    waiting = waiting_logs(spark, waiting_path)
    if waiting is not None:
        land(spark, waiting.drop("batch"), None)
        files.delete(spark, f"{checkpoint}/staged")
    return (
        observed.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
