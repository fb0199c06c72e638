"""Running totals of an ingest: events, rejects and the exact sum of all values, over any number of runs.

A 256-bit sum is 13 sums of 20-bit slices (see ``functions.amounts``), which add up as integers. They are kept in two ways. With the checkpoint, each
batch stores the totals up to and with itself: those that the batch before it stored, and its own. A batch that is replayed
stores the same again, so totals are right whatever a run was stopped in. ``RunningTotals`` listens to a query instead and
adds up what its batches observe, to tell totals while it runs.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from transferlens.functions.amounts import SLICE_BITS, U256Amounts
from transferlens.sources import files

VALUE = "_value"
SUMS = [f"total_value_{i}" for i in range(13)]
COUNTS = ["events", "rejects"]
KEPT = T.StructType([T.StructField(c, T.LongType()) for c in [*COUNTS, *SUMS]])


def measures() -> list[Column]:
    """Counts and slice sums of logs with their decoded value, NULL for rejects, in the column VALUE."""
    decoded = F.col(VALUE).isNotNull()
    sums = [F.coalesce(part, F.lit(0).cast("bigint")).alias(name) for part, name in zip(U256Amounts().partial_sums("total_value", F.col(VALUE)), SUMS, strict=True)]
    return [F.count_if(decoded).alias("events"), F.count_if(~decoded).alias("rejects"), *sums]


def _folder(checkpoint: str, batch: int | None = None) -> str:
    return f"{checkpoint}/totals" if batch is None else f"{checkpoint}/totals/batch={batch}"


def keep_totals(batch: DataFrame, checkpoint: str, batch_id: int) -> None:
    """Stores the totals up to and with this batch; those of the batch before it stay, as a replay starts from them."""
    spark = batch.sparkSession
    own = batch.agg(*measures())
    before = _folder(checkpoint, batch_id - 1)
    if files.exists(spark, before):
        own = own.unionByName(spark.read.schema(KEPT).parquet(before)).agg(*(F.sum(c).alias(c) for c in KEPT.names))
    own.coalesce(1).write.mode("overwrite").parquet(_folder(checkpoint, batch_id))
    files.delete(spark, _folder(checkpoint, batch_id - 2))


def _latest(spark: SparkSession, checkpoint: str) -> str | None:
    # A batch whose totals were not written to their end has no _SUCCESS and is replayed.
    done = [n for n in files.names(spark, _folder(checkpoint)) if files.exists(spark, f"{_folder(checkpoint)}/{n}/_SUCCESS")]
    return f"{_folder(checkpoint)}/{max(done, key=lambda n: int(n.partition('=')[2]))}" if done else None


def ingest_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row: events, rejects and total_value (256 bits) of all logs that the runs with this checkpoint have read."""
    latest = _latest(spark, checkpoint)
    kept = spark.read.schema(KEPT).parquet(latest) if latest else spark.createDataFrame([(0,) * len(KEPT)], KEPT)
    return U256Amounts().finish_sums(kept, ["total_value"])


class RunningTotals(StreamingQueryListener):
    """Totals of ingest queries while they run: ``events``, ``rejects`` and ``total_value``, an exact int.

    ``spark.streams.addListener(RunningTotals.since(spark, checkpoint))`` starts from what earlier runs have read. A batch counts once, however
    often its progress is told.
    """

    def __init__(self, events: int = 0, rejects: int = 0, total_value: int = 0):
        self.events, self.rejects, self.total_value = events, rejects, total_value
        self._seen: set[tuple[str, int]] = set()
        self._lock = threading.Lock()

    @classmethod
    def since(cls, spark: SparkSession, checkpoint: str) -> RunningTotals:
        latest = _latest(spark, checkpoint)
        return cls(*cls._numbers(spark.read.schema(KEPT).parquet(latest).first())) if latest else cls()

    @staticmethod
    def _numbers(row) -> tuple[int, int, int]:
        total = sum(row[name] << SLICE_BITS * (len(SUMS) - 1 - i) for i, name in enumerate(SUMS))
        return row["events"], row["rejects"], total

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get("ingest")
        with self._lock:
            batch = (str(progress.runId), progress.batchId)
            if row is None or batch in self._seen or not progress.numInputRows:
                return
            self._seen.add(batch)
            events, rejects, total = self._numbers(row)
            self.events, self.rejects, self.total_value = self.events + events, self.rejects + rejects, self.total_value + total

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
