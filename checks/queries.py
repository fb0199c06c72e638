"""The query registry: every analytic and job over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views
from transferlens.functions.amounts import aggregate, amounts_of, u256_from_long, u256_from_text
from transferlens.operators.ledger import token_balances
from transferlens.plans import activity, discovery, holders, tokens
from transferlens.schema import unknown_chains, with_chain
from transferlens.session import shared_folder
from transferlens.sources import catalog
from transferlens.sources import metadata as metadata_source
from transferlens.sources import raw_logs as log_source
from transferlens.sources import transfers as transfer_source
from transferlens.streaming.daily import stream_daily_activity, stream_daily_users
from transferlens.streaming.ingest import ingest_stream
from transferlens.streaming import kept as keep
from transferlens.streaming.kept import keep_aggregates, merge_kept
from transferlens.streaming.totals import ingest_totals

Query = Callable[[SparkSession, str], DataFrame]

TOKEN = "0x" + format(1003, "040x")
# Supplier and customer keys both start at 0, so this address sends and receives at every scale.
USER = "0x" + format(7, "040x")

LANDED = [
    "chain_id",
    "block_number",
    "block_timestamp",
    "log_index",
    "transaction_hash",
    "contract_address",
    "from_address",
    "to_address",
    "value",
]


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 4 decimals and wide decimals to digits, so that two engines print them alike."""
    doubles = {f.name: F.round(f.name, 4) for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    amounts = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns({**doubles, **amounts})


def on_transfers(plan: Callable[..., DataFrame], **parameters) -> Query:
    return lambda spark, sf_dir: rounded(plan(views.transfers(spark, sf_dir), **parameters))


def on_both(plan: Callable[..., DataFrame], **parameters) -> Query:
    return lambda spark, sf_dir: rounded(
        plan(views.transfers(spark, sf_dir), views.metadata(spark, sf_dir), **parameters)
    )


def on_metadata(plan: Callable[..., DataFrame], **parameters) -> Query:
    return lambda spark, sf_dir: rounded(plan(views.metadata(spark, sf_dir), **parameters))


def as_text(t: DataFrame) -> DataFrame:
    """Amounts as decimal digits, the form both engines share for 256 bits."""
    return t.withColumn("value", amounts_of(t).to_text(F.col("value")))


def landed_rows(t: DataFrame) -> DataFrame:
    return as_text(t.select(*LANDED))


def wide(t: DataFrame) -> DataFrame:
    """The derived amounts, which fit a BIGINT, as 256-bit amounts."""
    return t.withColumn("value", u256_from_long(F.col("value").cast("bigint")))


# Jobs -----------------------------------------------------------------------------------------------


def raw_logs_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "logs")
    views.raw_logs(spark, sf_dir).write.json(path, compression="gzip")
    logs = log_source.read_raw_logs(spark, path, "json")
    return logs.withColumn("topics", F.array_join("topics", ","))


def decode_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_rows(
        log_source.decode_transfers(views.raw_logs(spark, sf_dir), views.blocks(spark, sf_dir))
    )


def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = log_source.decode_rejects(views.raw_logs(spark, sf_dir))
    return rejects.withColumn("topics", F.array_join("topics", ","))


def _untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain transfers with overlong or missing fields, and some values above 1e30."""
    t = views.chain_transfers(spark, sf_dir)
    line = F.col("l_linenumber")
    return t.select(
        "block_number",
        "log_index",
        F.when(line == 5, F.concat("transaction_hash", F.repeat("l_returnflag", F.lit(90))))
        .otherwise(F.col("transaction_hash"))
        .alias("transaction_hash"),
        "contract_address",
        F.when(line == 3, F.concat("from_address", F.lit("ffff"))).otherwise(F.col("from_address")).alias("from_address"),
        F.when(line != 2, F.col("to_address")).alias("to_address"),
        F.when(line == 6, F.expr("cast(cents * cast('1' || repeat('0', 25) as decimal(26,0)) as decimal(38,0))"))
        .otherwise(F.col("value"))
        .alias("value"),
    )


def sanitize_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(transfer_source.sanitize(_untidy(spark, sf_dir)))


def oversize_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _untidy(spark, sf_dir)
    return transfer_source.oversize_audit(t.withColumn("value", u256_from_text(F.col("value").cast("string"))))


def write_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "transfers")
    transfer_source.write_transfers(wide(views.chain_transfers(spark, sf_dir).select(*LANDED)), path)
    t = transfer_source.read_transfers(spark, path, 130)
    return landed_rows(t).withColumn("block_date", F.to_date("block_timestamp"))


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of log files into one table. The second one repeats the logs of the first, and the blocks of half of
    the first come only then."""
    logs, blocks, table = (shared_folder(spark, name) for name in ("logs", "blocks", "transfers"))
    checkpoint = shared_folder(spark, "checkpoint")
    source, times = views.raw_logs(spark, sf_dir), views.blocks(spark, sf_dir)
    block = F.col("block_number")
    middle = source.agg(F.max("block_number").alias("b")).select(F.expr("b div 2")).scalar()
    early = times.agg(F.max("block_number").alias("b")).select(F.expr("b div 4")).scalar()
    for delivery, known in ((source.filter(block <= middle), times.filter(block <= early)), (source, times.filter(block > early))):
        delivery.write.mode("append").parquet(logs)
        known.write.mode("append").parquet(blocks)
        ingest_stream(spark, logs, blocks, table, checkpoint).awaitTermination()
    return landed_rows(transfer_source.read_transfers(spark, table, 130))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs that a stream could not decode, from two deliveries."""
    names = ("logs", "blocks", "transfers", "checkpoint", "rejects")
    logs, blocks, table, checkpoint, rejects = (shared_folder(spark, name) for name in names)
    source = views.raw_logs(spark, sf_dir)
    views.blocks(spark, sf_dir).write.parquet(blocks)
    middle = source.agg(F.max("block_number").alias("b")).select(F.expr("b div 2")).scalar()
    for delivery in (source.filter(F.col("block_number") <= middle), source.filter(F.col("block_number") > middle)):
        delivery.write.mode("append").parquet(logs)
        ingest_stream(spark, logs, blocks, table, checkpoint, rejects_path=rejects).awaitTermination()
    return spark.read.parquet(rejects).drop("batch").withColumn("topics", F.array_join("topics", ","))


def ingest_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checkpoint of two runs has counted."""
    logs, blocks, table, checkpoint = (shared_folder(spark, name) for name in ("logs", "blocks", "transfers", "checkpoint"))
    source = views.raw_logs(spark, sf_dir)
    views.blocks(spark, sf_dir).write.parquet(blocks)
    middle = source.agg(F.max("block_number").alias("b")).select(F.expr("b div 2")).scalar()
    for delivery in (source.filter(F.col("block_number") <= middle), source.filter(F.col("block_number") > middle)):
        delivery.write.mode("append").parquet(logs)
        ingest_stream(spark, logs, blocks, table, checkpoint).awaitTermination()
    totals = ingest_totals(spark, checkpoint)
    return totals.withColumn("total_value", amounts_of(totals, "total_value").to_text(F.col("total_value")))


def kept_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances kept up over two landings, late days first, with the files of each taken up in several batches and folded."""
    table, kept = shared_folder(spark, "transfers"), shared_folder(spark, "kept")
    t = wide(views.transfers(spark, sf_dir)).withColumn("transaction_hash", F.lit("0x")).select(*LANDED)
    middle = t.agg(F.max("block_timestamp").alias("b")).select(F.date_sub(F.to_date("b"), 365)).scalar()
    late = F.to_date("block_timestamp") > middle
    for landed in (t.filter(late), t.filter(~late)):
        transfer_source.write_transfers(landed, table)
        keep_aggregates(spark, table, kept).awaitTermination()
        merge_kept(spark, kept)
    balances = keep.kept_balances(spark, kept, 130).drop("chain_id")
    return _wide_text(balances, "balance")


def resume_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last block of a landed chain, from the footers of its files."""
    path = shared_folder(spark, "transfers")
    transfer_source.write_transfers(wide(views.chain_transfers(spark, sf_dir).select(*LANDED)), path)
    return catalog.highest(spark, path, "block_number", {"chain_id": 130}).withColumnRenamed("highest", "resume_block")


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by name that is written, extended, loses a chain and gets its last block again; what it holds by chain."""
    name = f"transfers_{uuid.uuid4().hex}"
    source = wide(views.all_chains(spark, sf_dir).withColumn("transaction_hash", F.lit("0x0")))
    middle = source.agg(F.max("block_number").alias("b")).select(F.expr("b div 2")).scalar()
    of_chain = F.col("chain_id") == 1
    try:
        transfer_source.write_transfers(source.filter((F.col("block_number") <= middle) | ~of_chain), name)
        transfer_source.replace_last_block(spark, name, source.filter(of_chain), 1)
        transfer_source.drop_chain(spark, name, 8453)
        t = transfer_source.read_transfers(spark, name)
        counts = aggregate(t, ["chain_id"], [F.count(F.lit(1)).alias("transfers"), F.max("block_number").alias("last_block")], {"total_value": "value"})
        counts = counts.withColumn("total_value", amounts_of(counts, "total_value").to_text(F.col("total_value")))
        return spark.createDataFrame(counts.collect(), counts.schema)  # a row per chain
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def resume_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer_source.resume_point(views.transfers(spark, sf_dir))


def replace_last_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that stops inside its last block, completed by collecting again from that block."""
    path = shared_folder(spark, "transfers")
    chain = views.chain_transfers(spark, sf_dir).select(*LANDED)
    middle = chain.agg((F.max("block_number") / 2).cast("bigint").alias("b")).scalar()
    block, log = F.col("block_number"), F.col("log_index")
    transfer_source.write_transfers(chain.filter((block < middle) | ((block == middle) & (log == 0))), path)
    transfer_source.replace_last_block(spark, path, chain, 130, amounts="decimal38")
    return landed_rows(transfer_source.read_transfers(spark, path, 130, amounts="decimal38"))


def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of a table that took one batch per day of block time."""
    t = wide(views.chain_transfers(spark, sf_dir).select(*LANDED))
    batches = t.withColumn("db_write_timestamp", F.date_trunc("day", "block_timestamp"))
    stats = transfer_source.ingest_stats(batches)
    return rounded(stats.withColumn("total_value", amounts_of(stats, "total_value").to_text(F.col("total_value"))))


def _metadata_folder(spark: SparkSession, sf_dir: str) -> str:
    path = shared_folder(spark, "metadata")
    documents = views.metadata_documents(spark, sf_dir)
    documents.write.partitionBy("file").option("maxRecordsPerFile", 1).text(path)
    return path


def load_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shared_folder(spark, "token-metadata")
    metadata_source.write_metadata(
        metadata_source.load_metadata(spark, _metadata_folder(spark, sf_dir)), table
    )
    return metadata_source.read_metadata(spark, table).drop("created_at")


def metadata_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata_source.metadata_rejects(spark, _metadata_folder(spark, sf_dir))


def metadata_chain_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = metadata_source.load_metadata(spark, _metadata_folder(spark, sf_dir))
    return metadata_source.metadata_summary(loaded)


def chain_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers per registered chain, and per id without an entry."""
    t = views.all_chains(spark, sf_dir)
    t = t.withColumn("chain_id", F.when(F.col("log_index") == 7, 999).otherwise(F.col("chain_id")))
    counts = t.groupBy("chain_id").agg(F.count(F.lit(1)).alias("transfers"))
    unknown = unknown_chains(counts).select("chain_id", F.lit(False).alias("known"))
    return with_chain(counts).join(unknown, "chain_id", "left").select(
        "chain_id", "chain_name", "transfers", F.coalesce("known", F.lit(True)).alias("known")
    )


def drop_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed table of three chains that loses one."""
    path = shared_folder(spark, "transfers")
    source = views.all_chains(spark, sf_dir).withColumn("transaction_hash", F.lit("0x0"))
    transfer_source.write_transfers(wide(source), path)
    transfer_source.drop_chain(spark, path, 8453)
    t = transfer_source.read_transfers(spark, path)
    return t.groupBy("chain_id").agg(F.count(F.lit(1)).alias("transfers"))


# Streams --------------------------------------------------------------------------------------------


def _run_stream(spark: SparkSession, sf_dir: str, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    landed, out, checkpoint = (shared_folder(spark, name) for name in ("landed", "daily", "checkpoint"))
    views.transfers(spark, sf_dir).write.parquet(landed)
    stream = spark.readStream.schema(spark.read.parquet(landed).schema).parquet(landed)
    result = plan(stream)
    query = (
        result.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


def daily_activity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_run_stream(spark, sf_dir, stream_daily_activity))


def daily_users_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stream(spark, sf_dir, stream_daily_users)


# Amounts in 256 bits over the same plans ------------------------------------------------------------


def _wide_text(df: DataFrame, *columns: str) -> DataFrame:
    return rounded(df.withColumns({c: amounts_of(df, c).to_text(F.col(c)) for c in columns}))


def volume_leaders_u256(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, m = wide(views.transfers(spark, sf_dir)), views.metadata(spark, sf_dir)
    return _wide_text(tokens.volume_leaders(t, m), "total_volume", "largest_transfer")


def token_balances_u256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_text(token_balances(wide(views.transfers(spark, sf_dir))), "balance")


def huge(t: DataFrame) -> DataFrame:
    """Amounts of 76 digits, close to 2^255 and so above it in sums: the derived amount and its block, 58 digits higher, and its log below."""
    value = F.col("value").cast("bigint")
    upper, lower = value * 10**11 + F.col("block_number"), value * 10**10 + F.col("log_index")
    return t.withColumn("value", u256_from_text(F.concat(upper.cast("string"), F.lpad(lower.cast("string"), 58, "0"))))


def volume_leaders_huge(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaders = tokens.volume_leaders(huge(views.transfers(spark, sf_dir)), views.metadata(spark, sf_dir))
    return _wide_text(leaders.drop("avg_transfer_size"), "total_volume", "largest_transfer")


def token_balances_huge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_text(token_balances(huge(views.transfers(spark, sf_dir))), "balance")


def registry() -> dict[str, Query]:
    as_of = {"as_of": views.AS_OF}
    return {
        # jobs
        "raw_logs_source": raw_logs_source,
        "decode_transfers": decode_transfers,
        "decode_rejects": decode_rejects,
        "sanitize_transfers": sanitize_transfers,
        "oversize_audit": oversize_audit,
        "write_transfers": write_transfers,
        "ingest_stream": ingest,
        "ingest_rejects": ingest_rejects,
        "ingest_totals": ingest_running_totals,
        "kept_balances": kept_balances,
        "resume_point": resume_point,
        "resume_block": resume_block,
        "catalog_table": catalog_table,
        "replace_last_block": replace_last_block,
        "ingest_stats": ingest_stats,
        "load_metadata": load_metadata,
        "metadata_rejects": metadata_rejects,
        "metadata_chain_summary": metadata_chain_summary,
        "chain_registry": chain_registry,
        "drop_chain": drop_chain,
        # activity
        "ecosystem_summary": on_transfers(activity.ecosystem_summary),
        "top_active_tokens": on_both(activity.top_active_tokens),
        "daily_activity": on_transfers(activity.daily_activity, **as_of),
        "hourly_pattern": on_transfers(activity.hourly_pattern, **as_of),
        "today_activity": on_transfers(activity.today_activity, day=views.TODAY),
        "trending_tokens": on_both(activity.trending_tokens, **as_of),
        "monthly_growth": on_transfers(activity.monthly_growth),
        "day_of_week_pattern": on_transfers(activity.day_of_week_pattern, **as_of),
        "chain_overview": lambda spark, sf_dir: activity.chain_overview(views.all_chains(spark, sf_dir)),
        "token_profile": on_transfers(activity.token_profile, token=TOKEN),
        "user_activity": on_transfers(activity.user_activity, address=USER),
        "activity_between": on_transfers(
            activity.activity_between, start="2024-02-01 00:00:00", end="2024-03-15 12:00:00"
        ),
        # tokens
        "volume_leaders": on_both(tokens.volume_leaders),
        "transfer_size_distribution": on_both(tokens.transfer_size_distribution),
        "whale_transfers": on_both(tokens.whale_transfers),
        "fastest_growing": on_both(tokens.fastest_growing, **as_of),
        "minting_activity": on_both(tokens.minting_activity),
        "token_velocity": on_both(tokens.token_velocity),
        # holders
        "top_senders": on_transfers(holders.top_senders),
        "top_receivers": on_transfers(holders.top_receivers),
        "multi_token_users": on_transfers(holders.multi_token_users),
        "holder_distribution": on_transfers(holders.holder_distribution, token=TOKEN),
        "user_portfolio": on_both(holders.user_portfolio, address=USER),
        "token_concentration": on_both(holders.token_concentration),
        "airdrop_candidates": on_both(holders.airdrop_candidates),
        "token_balances": on_transfers(token_balances),
        # discovery
        "symbol_search": on_metadata(discovery.symbol_search),
        "metadata_overview": on_metadata(discovery.metadata_overview),
        "unusual_decimals": on_metadata(discovery.unusual_decimals),
        "popular_symbols": on_metadata(discovery.popular_symbols),
        # streams
        "stream_daily_activity": daily_activity_stream,
        "stream_daily_users": daily_users_stream,
        # 256-bit amounts
        "volume_leaders_u256": volume_leaders_u256,
        "token_balances_u256": token_balances_u256,
        "volume_leaders_huge": volume_leaders_huge,
        "token_balances_huge": token_balances_huge,
    }
