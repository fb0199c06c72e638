"""Daily activity over a stream of transfers, in append mode: a day comes out once it can no longer change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.functions.amounts import aggregate


def _days(t: DataFrame, delay: str) -> DataFrame:
    """Event time must be TIMESTAMP for a watermark."""
    timed = t.withColumn("block_timestamp", F.col("block_timestamp").cast("timestamp"))
    return timed.withWatermark("block_timestamp", delay).withColumn("day", F.window("block_timestamp", "1 day"))


def stream_daily_activity(t: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Transfers and volume per day."""
    daily = aggregate(
        _days(t, delay), ["day"], [F.count(F.lit(1)).alias("daily_transfers")], {"daily_volume": "value"}
    )
    return daily.select(F.to_date("day.start").alias("date"), "daily_transfers", "daily_volume")


def stream_daily_users(t: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Exact number of senders per day. Streams have no distinct aggregate, so the state first keeps each
    (day, sender) once; it is keyed by both, spread over all tasks, and dropped with the watermark."""
    users = _days(t, delay).select("day", "from_address").dropDuplicates(["day", "from_address"])
    daily = users.groupBy("day").agg(F.count(F.lit(1)).alias("unique_users"))
    return daily.select(F.to_date("day.start").alias("date"), "unique_users")
