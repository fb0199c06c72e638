"""Analytics per address: active users, holders, portfolios, concentration, airdrops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.functions.amounts import aggregate, amounts_of
from transferlens.functions.counting import distinct, transfers
from transferlens.operators.ledger import token_balances
from transferlens.operators.metadata_join import with_metadata
from transferlens.operators.ordering import top
from transferlens.operators.ranking import first_per_group
from transferlens.session import staged


def top_senders(
    t: DataFrame, *, min_transfers: int = 10, limit: int | None = 50, approx: bool = False
) -> DataFrame:
    senders = aggregate(
        t,
        ["from_address"],
        [transfers().alias("transactions_sent"), distinct("contract_address", approx).alias("tokens_used")],
        {"total_sent_volume": "value"},
    )
    active = senders.filter(F.col("transactions_sent") > min_transfers)
    return top(active, limit, F.desc("transactions_sent"), "from_address")


def top_receivers(
    t: DataFrame, *, min_transfers: int = 10, limit: int | None = 50, approx: bool = False
) -> DataFrame:
    receivers = aggregate(
        t,
        ["to_address"],
        [transfers().alias("transactions_received"), distinct("contract_address", approx).alias("tokens_received")],
        {"total_received_volume": "value"},
    )
    active = receivers.filter(F.col("transactions_received") > min_transfers)
    return top(active, limit, F.desc("transactions_received"), "to_address")


def multi_token_users(t: DataFrame, *, min_tokens: int = 5, limit: int | None = 30) -> DataFrame:
    """Per address the larger of its numbers of sent and of received tokens, and all its interactions.

    Counting per (address, token) first makes each token a single row per address, so no distinct
    aggregate is needed and a hot address is spread over its tokens.
    """
    roles = F.array(
        F.struct(F.col("from_address").alias("address"), F.lit(True).alias("sends")),
        F.struct(F.col("to_address").alias("address"), F.lit(False).alias("sends")),
    )
    pairs = (
        t.select("contract_address", F.inline(roles))
        .groupBy("address", "contract_address")
        .agg(F.count_if("sends").alias("sent"), F.count_if(~F.col("sends")).alias("received"))
    )
    users = pairs.groupBy("address").agg(
        F.greatest(F.count_if(F.col("sent") > 0), F.count_if(F.col("received") > 0)).alias("max_token_count"),
        F.sum(F.col("sent") + F.col("received")).alias("total_interactions"),
    )
    diverse = users.filter(F.col("max_token_count") >= min_tokens)
    return top(diverse, limit, F.desc("max_token_count"), F.desc("total_interactions"), "address")


def holder_distribution(t: DataFrame, token: str, *, limit: int | None = 100) -> DataFrame:
    """Positive balances of one token with their share of the positive supply, largest first.

    The supply is a one-row scalar subquery over the same balances, not a window without partitions,
    which would move all holders into one task.
    """
    balances = token_balances(t.filter(F.col("contract_address") == token))
    amounts = amounts_of(balances, "balance")
    supply = aggregate(balances, [], [], {"total": "balance"}).select(amounts.to_double(F.col("total")).alias("supply"))
    holders = balances.select(
        F.col("address").alias("holder_address"),
        "balance",
        F.try_divide(amounts.to_double(F.col("balance")) * 100.0, supply.scalar()).alias("percentage_of_supply"),
    )
    return top(holders, limit, F.desc("balance"), "holder_address")


def user_portfolio(
    t: DataFrame, m: DataFrame, address: str, *, limit: int | None = 50, missing: str = "null"
) -> DataFrame:
    """Positive balances of one address. A single scan with the address filter pushed down."""
    amounts = amounts_of(t)
    sent, received = F.col("from_address") == address, F.col("to_address") == address
    own = t.filter(sent | received).withColumn("change", amounts.net(received, sent, F.col("value")))
    held = aggregate(own, ["contract_address"], [], {"balance": "change"}, positive="balance")
    named = with_metadata(held, m, "name", "symbol", missing=missing)
    return top(named, limit, F.desc("balance"), "contract_address")


def token_concentration(
    t: DataFrame,
    m: DataFrame,
    *,
    top_holders: int = 10,
    min_holders: int = 50,
    limit: int | None = 20,
    missing: str = "null",
) -> DataFrame:
    """Share of the positive supply that each token's largest holders own.

    Supply and holder count combine map-side. The ranking goes by parts of a token, for any ``top_holders``, so a token with very
    many holders does not end up whole in one task. The balances are computed once and written; both read them.
    """
    key = "contract_address"
    balances = staged(token_balances(t), "balances")
    amounts = amounts_of(balances, "balance")
    supply = aggregate(balances, [key], [F.count(F.lit(1)).alias("total_holders")], {"total_supply": "balance"})
    supply = supply.filter(F.col("total_holders") >= min_holders)
    most = supply.agg(F.coalesce(F.max("total_holders"), F.lit(0))).scalar()
    ranked = first_per_group(balances, key, "address", [F.desc("balance"), "address"], top_holders, most)
    held = f"top_{top_holders}_holders_balance"
    largest = aggregate(ranked, [key], [], {held: "balance"})
    shares = supply.join(largest, key).select(
        key,
        "total_holders",
        held,
        F.try_divide(amounts.to_double(F.col(held)) * 100.0, amounts.to_double(F.col("total_supply"))).alias(
            "concentration_percent"
        ),
    )
    named = with_metadata(shares, m, "symbol", missing=missing)
    return top(named, limit, F.desc("concentration_percent"), key)


def airdrop_candidates(
    t: DataFrame,
    m: DataFrame,
    *,
    min_recipients: int = 50,
    min_transfers: int = 50,
    max_days: int = 7,
    limit: int | None = 25,
    approx: bool = False,
    missing: str = "null",
) -> DataFrame:
    """Senders that gave one token to many addresses within a short span."""
    senders = aggregate(
        t,
        ["contract_address", F.col("from_address").alias("distributor")],
        [
            distinct("to_address", approx).alias("unique_recipients"),
            transfers().alias("total_distributions"),
            F.min("block_timestamp").alias("first_distribution"),
            F.max("block_timestamp").alias("last_distribution"),
        ],
        {"total_distributed": "value"},
    ).filter(
        (F.col("unique_recipients") >= min_recipients)
        & (F.col("total_distributions") >= min_transfers)
        & (
            F.col("last_distribution") - F.col("first_distribution")
            <= F.expr(f"INTERVAL '{int(max_days)}' DAY")
        )
    )
    senders = senders.select(
        "contract_address",
        "distributor",
        "unique_recipients",
        "total_distributions",
        "total_distributed",
        "first_distribution",
        "last_distribution",
    )
    named = with_metadata(senders, m, "symbol", missing=missing)
    return top(named, limit, F.desc("unique_recipients"), "contract_address", "distributor")
