"""Fixed schemas, constants and the chain registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.functions.amounts import DECIMAL38, U256

ZERO_ADDRESS = "0x" + "0" * 40

# keccak256("Transfer(address,address,uint256)"), fixed by the token standard.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"

# Chain ids and their display names.
CHAINS = {
    1: "Ethereum",
    10: "Optimism",
    56: "BSC",
    130: "Unichain",
    137: "Polygon",
    480: "World Chain",
    1868: "Lightlink",
    7777777: "Zora",
    8453: "Base",
    42161: "Arbitrum",
    43114: "Avalanche",
    81457: "Blast",
}
DEFAULT_CHAIN = 130

RAW_LOGS = T.StructType(
    [
        T.StructField("block_number", T.LongType()),
        T.StructField("log_index", T.LongType()),
        T.StructField("transaction_hash", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("data", T.StringType()),
    ]
)

# Block times arrive as epoch seconds.
BLOCKS = T.StructType(
    [
        T.StructField("block_number", T.LongType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

TOKEN_METADATA = T.StructType(
    [
        T.StructField("chain_id", T.LongType()),
        T.StructField("contract_address", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("decimals", T.ShortType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


def transfers_schema(amounts: str = "u256") -> T.StructType:
    """Schema of the landed transfers table, for ``u256`` or ``decimal38`` amounts."""
    value = {"u256": U256, "decimal38": DECIMAL38}[amounts]
    return T.StructType(
        [
            T.StructField("block_number", T.LongType()),
            T.StructField("block_timestamp", T.TimestampType()),
            T.StructField("log_index", T.LongType()),
            T.StructField("transaction_hash", T.StringType()),
            T.StructField("contract_address", T.StringType()),
            T.StructField("from_address", T.StringType()),
            T.StructField("to_address", T.StringType()),
            T.StructField("value", value),
            T.StructField("db_write_timestamp", T.TimestampType()),
            T.StructField("chain_id", T.LongType()),
            T.StructField("block_date", T.DateType()),
        ]
    )


def check_chain(chain_id: int) -> int:
    if chain_id not in CHAINS:
        known = ", ".join(f"{i} ({name})" for i, name in CHAINS.items())
        raise ValueError(f"Unsupported chain id {chain_id}; available: {known}")
    return chain_id


def with_chain(t: DataFrame) -> DataFrame:
    """Add ``chain_name``, NULL for an unknown id. The registry is a fixed map, so this is a projection."""
    names = F.create_map(*(F.lit(x) for entry in CHAINS.items() for x in entry))
    return t.withColumn("chain_name", F.try_element_at(names, F.col("chain_id").cast("int")))


def unknown_chains(t: DataFrame) -> DataFrame:
    """Rows whose chain id is not in the registry."""
    return t.filter(~F.coalesce(F.col("chain_id").isin(*CHAINS), F.lit(False)))
