"""Raw event logs: reading, decoding, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.functions.amounts import u256_from_hex
from transferlens.schema import BLOCKS, DEFAULT_CHAIN, RAW_LOGS, TRANSFER_TOPIC, check_chain

WORD = "^0x[0-9a-fA-F]{64}$"


def read_raw_logs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Transfer logs with the fixed schema, so that nothing is inferred and other columns are never read."""
    return transfer_logs(spark.read.schema(RAW_LOGS).format(fmt).load(path))


def read_blocks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(BLOCKS).format(fmt).load(path)


def transfer_logs(logs: DataFrame) -> DataFrame:
    """Keep logs whose first topic is the Transfer signature."""
    return logs.filter(F.try_element_at("topics", F.lit(1)) == TRANSFER_TOPIC)


def _topic(position: int) -> Column:
    return F.try_element_at("topics", F.lit(position))


def _is_word(column: Column) -> Column:
    return F.coalesce(column.rlike(WORD), F.lit(False))


def _topic_count_ok() -> Column:
    return F.coalesce(F.size("topics") == 3, F.lit(False))


def _topics_ok() -> Column:
    return _is_word(_topic(2)) & _is_word(_topic(3))


def _has_identity() -> Column:
    return F.col("block_number").isNotNull() & F.col("log_index").isNotNull()


def decodable() -> Column:
    """Three topics, 32 bytes of data and an identity. Four topics are the same event of non-fungible tokens."""
    return _topic_count_ok() & _topics_ok() & _is_word(F.col("data")) & _has_identity()


def amount() -> Column:
    """The value of a decodable log."""
    return u256_from_hex(F.substring("data", 3, 64))


def _address(word: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.right(word, F.lit(40))))


def _parsed() -> dict[str, Column]:
    return {
        "block_number": F.col("block_number"),
        "log_index": F.col("log_index"),
        "transaction_hash": F.coalesce("transaction_hash", F.lit("0x0")),
        "contract_address": F.lower(F.coalesce("address", F.lit("0x0"))),
        "from_address": _address(_topic(2)),
        "to_address": _address(_topic(3)),
        "value": amount(),
    }


def parse_logs(logs: DataFrame) -> DataFrame:
    """Decodable logs as (block_number, log_index, transaction_hash, contract_address, from_address,
    to_address, value). A missing hash or address gets a default. Stateless, so it also runs on streams."""
    return transfer_logs(logs).filter(decodable()).select(*(c.alias(name) for name, c in _parsed().items()))


def sorted_out(logs: DataFrame) -> DataFrame:
    """Every Transfer log in one pass: the columns of ``parse_logs`` where it decodes, else ``reject``, the row of ``decode_rejects``.
    The others are NULL. Stateless, so it also runs on streams."""
    told = transfer_logs(logs).withColumn("_decodes", decodable())
    decodes = F.col("_decodes")
    parsed = (F.when(decodes, c).alias(name) for name, c in _parsed().items())
    return told.select(*parsed, F.when(~decodes, F.struct(*_rejected())).alias("reject"))


def with_block_time(
    parsed: DataFrame, blocks: DataFrame, chain_id: int = DEFAULT_CHAIN, missing_time: Column | None = None
) -> DataFrame:
    """Give each log the time of its own block; a log whose block is missing gets ``missing_time``, by
    default the current time.

    The logs are parsed before this join, so a shuffle moves the narrow decoded rows, not hex text. A block
    holds a bounded number of logs, so the join key has no hot values.
    """
    default = F.current_timestamp() if missing_time is None else missing_time
    times = blocks.select("block_number", F.timestamp_seconds("timestamp").alias("block_timestamp"))
    return parsed.join(times, "block_number", "left").select(
        F.lit(check_chain(chain_id)).cast("bigint").alias("chain_id"),
        "block_number",
        F.coalesce("block_timestamp", default).alias("block_timestamp"),
        "log_index",
        "transaction_hash",
        "contract_address",
        "from_address",
        "to_address",
        "value",
    )


def decode_transfers(logs: DataFrame, blocks: DataFrame, chain_id: int = DEFAULT_CHAIN) -> DataFrame:
    return with_block_time(parse_logs(logs), blocks, chain_id)


def _rejected() -> list[Column | str]:
    reason = (
        F.when(~_topic_count_ok(), "topic count is not 3")
        .when(~_topics_ok(), "topic is not a 32-byte word")
        .when(~_is_word(F.col("data")), "data is not a 32-byte word")
        .otherwise("block number or log index is missing")
    )
    return ["block_number", "log_index", "transaction_hash", "address", "topics", "data", reason.alias("reason")]


def decode_rejects(logs: DataFrame) -> DataFrame:
    """Transfer logs that do not decode, with the reason."""
    return transfer_logs(logs).filter(~decodable()).select(*_rejected())
