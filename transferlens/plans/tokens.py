"""Analytics per token: volume, transfer sizes, whales, growth, mints, velocity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.functions import periods
from transferlens.functions.amounts import aggregate, amounts_of
from transferlens.functions.counting import distinct, transfers
from transferlens.operators.metadata_join import with_metadata
from transferlens.operators.ordering import top
from transferlens.operators.quantiles import log_histogram, quantiles_from_histogram
from transferlens.schema import ZERO_ADDRESS
from transferlens.session import staged


def volume_leaders(
    t: DataFrame, m: DataFrame, *, limit: int | None = 20, missing: str = "null"
) -> DataFrame:
    amounts = amounts_of(t)
    mean = amounts.to_double(F.col("total_volume")) / F.col("transfer_count").cast("double")
    tokens = amounts.summary(t, ["contract_address"]).select(
        "contract_address", "transfer_count", "total_volume", mean.alias("avg_transfer_size"), "largest_transfer"
    )
    named = with_metadata(tokens, m, "name", "symbol", "decimals", missing=missing)
    return top(named, limit, F.desc("total_volume"), "contract_address")


SIZE_QUANTILES = {"median_transfer": 0.5, "p90_transfer": 0.9, "p99_transfer": 0.99}


def transfer_size_distribution(
    t: DataFrame,
    m: DataFrame,
    *,
    min_transfers: int = 1000,
    limit: int | None = 15,
    method: str = "exact",
    accuracy: int = 10_000,
    missing: str = "null",
) -> DataFrame:
    """Median, p90 and p99 for the tokens with more than ``min_transfers`` transfers.

    ``method="exact"`` first picks the tokens by their addresses alone, then reads the amounts of these in three passes (more
    only where many amounts crowd together).
    ``method="approx"`` is one pass with mergeable sketches.
    """
    key = "contract_address"
    values = t.select(key, amounts_of(t).to_double(F.col("value")).alias("v"))
    order = (F.desc("transfers"), key)
    if method == "approx":
        sketches = values.groupBy(key).agg(
            transfers().alias("transfers"),
            *(F.percentile_approx("v", q, accuracy).alias(name) for name, q in SIZE_QUANTILES.items()),
        )
        sizes = sketches.filter(F.col("transfers") > min_transfers)
        return top(with_metadata(sizes, m, "symbol", missing=missing), limit, *order)

    active = t.groupBy(key).agg(transfers().alias("transfers")).filter(F.col("transfers") > min_transfers)
    if limit is None:
        # Any number of tokens: bins first, so that only bins are shuffled by token.
        histogram = log_histogram(values, [key]).join(active.select(key), key)
    else:
        values = values.join(staged(top(active, limit, *order).select(key), "tokens"), key, "left_semi")
        histogram = log_histogram(values, [key])
    sizes = quantiles_from_histogram(values, histogram, [key], SIZE_QUANTILES)
    named = with_metadata(sizes.withColumnRenamed("total", "transfers"), m, "symbol", missing=missing)
    return named.orderBy(*order)


def whale_transfers(
    t: DataFrame,
    m: DataFrame,
    *,
    quantile: float = 0.999,
    limit: int | None = 50,
    method: str = "exact",
    accuracy: int = 1_000_000,
    missing: str = "null",
) -> DataFrame:
    """Transfers strictly above the quantile of all values, all tokens pooled."""
    amounts = amounts_of(t)
    size = amounts.to_double(F.col("value"))
    values = t.select(size.alias("v"))
    if method == "approx":
        cutoff = values.agg(F.percentile_approx("v", quantile, accuracy).alias("cutoff"))
    else:
        # Without keys the histogram has at most 256 bins per power of two, 65,792 rows in all.
        cutoff = quantiles_from_histogram(
            values, log_histogram(values, []), [], {"cutoff": quantile}
        ).select("cutoff")
    columns = ["contract_address", "from_address", "to_address", "value", "block_timestamp"]
    order = (
        F.desc("value"),
        "contract_address",
        "block_timestamp",
        "from_address",
        "to_address",
    )
    whales = top(t.filter(size > cutoff.scalar()).select(*columns), limit, *order)
    named = with_metadata(whales, m, "symbol", missing=missing)
    return named.orderBy(*order).select("contract_address", "symbol", *columns[1:])


def fastest_growing(
    t: DataFrame,
    m: DataFrame,
    *,
    as_of: periods.AsOf = None,
    days: int = 30,
    min_recent: int = 100,
    min_historical: int = 100,
    limit: int | None = 20,
    missing: str = "null",
) -> DataFrame:
    """Recent transfers as a percentage of all earlier ones; the two periods differ in length."""
    recent = F.col("block_timestamp") >= periods.days_before(t, days, as_of)
    tokens = (
        periods.last_days(t, None, as_of)
        .groupBy("contract_address")
        .agg(
            F.count_if(recent).alias("recent_transfers"),
            F.count_if(~recent).alias("historical_transfers"),
        )
        .filter(
            (F.col("recent_transfers") > min_recent) & (F.col("historical_transfers") > min_historical)
        )
        .withColumn(
            "growth_rate_percent",
            F.coalesce(
                F.try_divide(
                    F.col("recent_transfers").cast("double"), F.col("historical_transfers").cast("double")
                )
                * 100,
                F.lit(0.0),
            ),
        )
    )
    named = with_metadata(tokens, m, "symbol", missing=missing)
    return top(named, limit, F.desc("growth_rate_percent"), "contract_address")


def minting_activity(
    t: DataFrame, m: DataFrame, *, limit: int | None = 20, approx: bool = False, missing: str = "null"
) -> DataFrame:
    """Transfers out of the zero address, per token."""
    tokens = aggregate(
        t.filter(F.col("from_address") == ZERO_ADDRESS),
        ["contract_address"],
        [transfers().alias("mint_events"), distinct("to_address", approx).alias("unique_recipients")],
        {"total_minted": "value"},
    ).select("contract_address", "mint_events", "total_minted", "unique_recipients")
    named = with_metadata(tokens, m, "name", "symbol", missing=missing)
    return top(named, limit, F.desc("total_minted"), "contract_address")


def token_velocity(
    t: DataFrame,
    m: DataFrame,
    *,
    min_transfers: int = 1000,
    limit: int | None = 25,
    approx: bool = False,
    missing: str = "null",
) -> DataFrame:
    """Transfers per party and per hour. An address that both sends and receives counts twice. The hourly
    rate is NULL for a token whose transfers all have one timestamp."""
    tokens = (
        t.groupBy("contract_address")
        .agg(
            transfers().alias("transfers"),
            distinct("from_address", approx).alias("senders"),
            distinct("to_address", approx).alias("receivers"),
            F.min("block_timestamp").alias("first"),
            F.max("block_timestamp").alias("last"),
        )
        .filter(F.col("transfers") >= min_transfers)
    )
    parties = F.col("senders") + F.col("receivers")
    hours = F.timestamp_diff("SECOND", F.col("first"), F.col("last")).cast("double") / F.lit(3600.0).cast("double")
    count = F.col("transfers").cast("double")
    rates = tokens.select(
        "contract_address",
        "transfers",
        parties.alias("unique_addresses"),
        F.try_divide(count, parties.cast("double")).alias("velocity_ratio"),
        F.try_divide(count, hours).alias("transfers_per_hour"),
    )
    named = with_metadata(rates, m, "symbol", missing=missing)
    return top(named, limit, F.desc_nulls_last("transfers_per_hour"), "contract_address")
