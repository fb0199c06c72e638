"""The analytics by name, for callers that pick one at run time."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame

from transferlens.operators.ledger import token_balances
from transferlens.plans import activity, discovery, holders, tokens

ANALYTICS: dict[str, Callable[..., DataFrame]] = {
    plan.__name__: plan
    for plan in (
        activity.ecosystem_summary,
        activity.top_active_tokens,
        activity.daily_activity,
        activity.hourly_pattern,
        activity.today_activity,
        activity.trending_tokens,
        tokens.volume_leaders,
        tokens.transfer_size_distribution,
        tokens.whale_transfers,
        holders.top_senders,
        holders.top_receivers,
        holders.multi_token_users,
        holders.holder_distribution,
        holders.user_portfolio,
        activity.monthly_growth,
        activity.day_of_week_pattern,
        tokens.fastest_growing,
        activity.chain_overview,
        discovery.symbol_search,
        holders.token_concentration,
        holders.airdrop_candidates,
        tokens.minting_activity,
        tokens.token_velocity,
        discovery.metadata_overview,
        discovery.unusual_decimals,
        discovery.popular_symbols,
        activity.token_profile,
        activity.user_activity,
        activity.activity_between,
        token_balances,
    )
}


def run_analytic(name: str, t: DataFrame, m: DataFrame, **parameters) -> DataFrame:
    """Run one analytic, giving it transfers and metadata as its signature asks for them."""
    plan = ANALYTICS[name]
    inputs = {"t": t, "m": m}
    wanted = {key: inputs[key] for key in inspect.signature(plan).parameters if key in inputs}
    return plan(**wanted, **parameters)
