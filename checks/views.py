"""Transfers, metadata, logs and blocks derived from the driver's tables, over their whole rows.

The same mapping in Spark (here) and in SQL (``checks/oracles.py``); FIXTURES.md describes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.functions.amounts import DECIMAL38
from transferlens.schema import TRANSFER_TOPIC
from transferlens.session import spread

AS_OF = "2024-04-10 00:00:00"
TODAY = "2024-04-29"
PERIOD = 120 * 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_word(number: Column | str, width: int) -> Column:
    return F.lpad(F.lower(F.hex(F.col(number) if isinstance(number, str) else number)), width, "0")


def addr(number: Column | str) -> Column:
    return F.concat(F.lit("0x"), hex_word(number, 40))


def _after_base(seconds: str) -> Column:
    return F.expr(f"timestampadd(SECOND, {seconds}, timestamp_ntz'2024-01-01 00:00:00')")


# A twentieth of the tokens takes most transfers, the rest form a long tail; every tenth sender gives out
# one token within five days.
TOKEN = """CASE WHEN l_suppkey % 10 = 1 THEN l_suppkey % 20
                WHEN l_quantity > 5 THEN l_partkey % 20
                ELSE l_partkey END + 1000"""
SPREAD = f"(l_orderkey * 7919 + l_linenumber * 104729) % {PERIOD}"
BURST = "((l_suppkey * 3) % 100) * 86400 + (l_orderkey * 7919 + l_linenumber * 104729) % 432000"
SECONDS = f"CASE WHEN l_suppkey % 10 = 1 THEN {BURST} ELSE {SPREAD} END"
CENTS = "round(l_extendedprice * 100)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.count()  # from the footers
    return spread(lines, rows, "l_orderkey").join(spread(orders, rows, "l_orderkey"), "l_orderkey")


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a transfer of one chain."""
    return _lines(spark, sf_dir).select(
        F.lit(130).cast("bigint").alias("chain_id"),
        F.col("l_orderkey").alias("block_number"),
        F.col("l_linenumber").cast("bigint").alias("log_index"),
        addr(F.expr(TOKEN)).alias("contract_address"),
        addr("l_suppkey").alias("from_address"),
        addr("o_custkey").alias("to_address"),
        F.expr(CENTS).cast("bigint").cast(DECIMAL38).alias("value"),
        _after_base(SECONDS).alias("block_timestamp"),
    )


def all_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transfers spread over three chains by token."""
    chain = F.conv(F.right("contract_address", F.lit(8)), 16, 10).cast("bigint") % 3
    return transfers(spark, sf_dir).withColumn(
        "chain_id", F.when(chain == 0, 1).when(chain == 1, 130).otherwise(8453).cast("bigint")
    )


def part_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a raw metadata entry; some lack a name, a symbol or numeric decimals."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_size",
        F.when(F.col("p_size") == 41, "").otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") == 13, "")
        .when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("USD"), F.col("p_partkey").cast("string")))
        .when(F.col("p_partkey") % 6 == 1, "usdc")
        .otherwise(F.col("p_brand"))
        .alias("symbol"),
        F.expr("CASE p_partkey % 5 WHEN 0 THEN 6 WHEN 1 THEN 8 WHEN 2 THEN 9 ELSE 18 END")
        .cast("smallint")
        .alias("decimals"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid metadata, as one chain's table."""
    valid = part_tokens(spark, sf_dir).filter(~F.col("p_size").isin(41, 13, 29))
    return valid.select(
        F.lit(130).cast("bigint").alias("chain_id"),
        addr(F.col("p_partkey") + 1000).alias("contract_address"),
        "name",
        "symbol",
        "decimals",
    )


def metadata_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value): JSON documents of up to 1000 tokens, for three chains.

    Addresses are upper case; tokens of size 7 appear in lower case too, with another name.
    """
    tokens = part_tokens(spark, sf_dir).withColumn("digits", hex_word(F.col("p_partkey") + 1000, 40))
    entry = F.concat(
        F.lit('{"name":"'),
        F.col("name"),
        F.lit('","symbol":"'),
        F.col("symbol"),
        F.lit('","decimals":'),
        F.when(F.col("p_size") == 29, F.concat(F.lit('"'), F.col("decimals").cast("string"), F.lit('"'))).otherwise(
            F.col("decimals").cast("string")
        ),
        F.lit("}"),
    )
    upper = F.concat(F.lit('"0x'), F.upper("digits"), F.lit('":'), entry)
    again = F.concat(F.lit('"0x'), F.col("digits"), F.lit('":{"name":"zz copy","symbol":"ZZ","decimals":0}'))
    pieces = F.when(F.col("p_size") == 7, F.array(upper, again)).otherwise(F.array(upper))
    chain = F.element_at(F.array(F.lit(1), F.lit(130), F.lit(8453)), (F.col("p_partkey") % 3 + 1).cast("int"))
    return (
        tokens.select(
            F.concat(F.lit("tokenMetadata_"), chain.cast("string"), F.lit(".json")).alias("file"),
            F.floor(F.col("p_partkey") / 1000).alias("chunk"),
            F.explode(pieces).alias("piece"),
        )
        .groupBy("file", "chunk")
        .agg(F.array_join(F.sort_array(F.collect_list("piece")), ",").alias("pieces"))
        .select("file", F.concat(F.lit("{"), F.col("pieces"), F.lit("}")).alias("value"))
    )


def chain_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers as a chain emits them: one time per block, log indexes unique within a block."""
    rows = _lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_suppkey",
        "o_custkey",
        F.expr(TOKEN).alias("token"),
        F.expr(CENTS).cast("bigint").alias("cents"),
    )
    position = F.expr(
        "row_number() OVER (PARTITION BY l_orderkey "
        "ORDER BY l_linenumber, token, l_suppkey, o_custkey, cents, l_returnflag) - 1"
    )
    return rows.select(
        F.lit(130).cast("bigint").alias("chain_id"),
        F.col("l_orderkey").alias("block_number"),
        F.expr(f"timestamp_seconds(1704067200 + (l_orderkey * 7919) % {PERIOD})").alias("block_timestamp"),
        position.cast("bigint").alias("log_index"),
        F.concat(F.lit("0x"), hex_word("l_orderkey", 64)).alias("transaction_hash"),
        addr("token").alias("contract_address"),
        addr("l_suppkey").alias("from_address"),
        addr("o_custkey").alias("to_address"),
        F.col("cents").cast(DECIMAL38).alias("value"),
        "cents",
        "l_linenumber",
        "l_returnflag",
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain's transfers as event logs. Line 7 has a fourth topic; returned lines 6 have short data,
    returned lines 5 a topic of 20 bytes, returned lines 4 another first topic."""
    t = chain_transfers(spark, sf_dir)
    returned = F.col("l_returnflag") == "R"
    line = F.col("l_linenumber")

    def word(address: str) -> Column:
        return F.concat(F.lit("0x"), F.lpad(F.substring(address, 3, 40), 64, "0"))

    signature = F.when(returned & (line == 4), F.concat(F.lit("0x"), F.lit("1" * 64))).otherwise(
        F.lit(TRANSFER_TOPIC)
    )
    sender = F.when(returned & (line == 5), F.col("from_address")).otherwise(word("from_address"))
    topics = F.array(signature, sender, word("to_address"))
    amount = F.concat(F.lit("0x"), hex_word("cents", 64))
    return t.select(
        "block_number",
        "log_index",
        "transaction_hash",
        F.concat(F.lit("0x"), F.upper(F.substring("contract_address", 3, 40))).alias("address"),
        F.when(line == 7, F.array_append(topics, amount)).otherwise(topics).alias("topics"),
        F.when(returned & (line == 6), F.substring(amount, 1, 40)).otherwise(amount).alias("data"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("block_number"),
        F.expr(f"1704067200 + (o_orderkey * 7919) % {PERIOD}").alias("timestamp"),
    )
