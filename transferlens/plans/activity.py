"""Activity of a chain, its tokens and its users over time."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.functions import periods
from transferlens.functions.amounts import DecimalAmounts, U256Amounts, aggregate, amounts_of
from transferlens.functions.counting import distinct, transfers
from transferlens.operators.distinct_aggregate import aggregate_with_distincts
from transferlens.operators.metadata_join import with_metadata
from transferlens.operators.ordering import top
from transferlens.schema import with_chain


def _or_zero(row: DataFrame, total: str, count: str) -> DataFrame:
    """For aggregates without keys, where no rows must give 0 rather than NULL."""
    zero = amounts_of(row, total).zero()
    return row.withColumn(total, F.when(F.col(count) == 0, zero).otherwise(F.col(total)))


def _mean(amounts: DecimalAmounts | U256Amounts, total: Column, count: Column) -> Column:
    """The exact sum as a double over the count, so the mean does not depend on task order."""
    return F.try_divide(amounts.to_double(total), count.cast("double"))


def _with_mean(df: DataFrame, t: DataFrame, count: str, name: str) -> DataFrame:
    return df.withColumn(name, _mean(amounts_of(t), F.col("_total"), F.col(count))).drop("_total")


def ecosystem_summary(t: DataFrame, *, approx: bool = False) -> DataFrame:
    measures = [
        transfers().alias("total_transfers"),
        F.min("block_timestamp").alias("earliest_activity"),
        F.max("block_timestamp").alias("latest_activity"),
    ]
    distincts = {
        "unique_tokens": "contract_address",
        "unique_senders": "from_address",
        "unique_receivers": "to_address",
    }
    summary = aggregate_with_distincts(t, [], measures, {"total_volume": "value"}, distincts, approx)
    return _or_zero(summary, "total_volume", "total_transfers").select(
        "total_transfers", *distincts, "total_volume", "earliest_activity", "latest_activity"
    )


def top_active_tokens(
    t: DataFrame, m: DataFrame, *, limit: int | None = 20, approx: bool = False, missing: str = "null"
) -> DataFrame:
    distincts = {"unique_senders": "from_address", "unique_receivers": "to_address"}
    tokens = aggregate_with_distincts(
        t,
        ["contract_address"],
        [transfers().alias("transfer_count")],
        {"total_volume": "value"},
        distincts,
        approx,
    ).select("contract_address", "transfer_count", *distincts, "total_volume")
    named = with_metadata(tokens, m, "name", "symbol", missing=missing)
    return top(named, limit, F.desc("transfer_count"), "contract_address")


def daily_activity(
    t: DataFrame,
    *,
    as_of: periods.AsOf = None,
    days: int | None = 30,
    limit: int | None = 30,
    approx: bool = False,
) -> DataFrame:
    recent = periods.last_days(t, days, as_of)
    distincts = {"active_tokens": "contract_address", "unique_users": "from_address"}
    daily = aggregate_with_distincts(
        recent,
        [periods.day_of(t).alias("date")],
        [transfers().alias("daily_transfers")],
        {"daily_volume": "value"},
        distincts,
        approx,
    ).select("date", "daily_transfers", *distincts, "daily_volume")
    return top(daily, limit, F.desc("date"))


def hourly_pattern(
    t: DataFrame, *, as_of: periods.AsOf = None, days: int | None = 7, approx: bool = False
) -> DataFrame:
    recent = periods.last_days(t, days, as_of)
    hours = aggregate(
        recent,
        [F.hour("block_timestamp").alias("hour_of_day")],
        [transfers().alias("transfer_count"), distinct("from_address", approx).alias("unique_users")],
        {"_total": "value"},
    )
    return _with_mean(hours, t, "transfer_count", "avg_transfer_value").orderBy("hour_of_day")


def today_activity(
    t: DataFrame, *, day: str | date | None = None, limit: int | None = 15, approx: bool = False
) -> DataFrame:
    tokens = aggregate(
        periods.on_day(t, day),
        ["contract_address"],
        [transfers().alias("today_transfers"), distinct("from_address", approx).alias("unique_senders")],
        {"today_volume": "value"},
    )
    return top(tokens, limit, F.desc("today_transfers"), "contract_address")


def trending_tokens(
    t: DataFrame,
    m: DataFrame,
    *,
    as_of: periods.AsOf = None,
    days: int | None = 7,
    limit: int | None = 20,
    approx: bool = False,
    missing: str = "null",
) -> DataFrame:
    tokens = aggregate(
        periods.last_days(t, days, as_of),
        ["contract_address"],
        [transfers().alias("recent_transfers"), distinct("from_address", approx).alias("recent_users")],
        {"recent_volume": "value"},
    )
    named = with_metadata(tokens, m, "name", "symbol", missing=missing)
    return top(named, limit, F.desc("recent_transfers"), "contract_address")


def monthly_growth(t: DataFrame, *, limit: int | None = 12, approx: bool = False) -> DataFrame:
    day = periods.day_of(t)
    distincts = {"active_tokens": "contract_address", "active_users": "from_address"}
    months = aggregate_with_distincts(
        t,
        [(F.year(day) * 100 + F.month(day)).alias("month")],
        [transfers().alias("monthly_transfers")],
        {"monthly_volume": "value"},
        distincts,
        approx,
    ).select("month", "monthly_transfers", *distincts, "monthly_volume")
    return top(months, limit, F.desc("month"))


def day_of_week_pattern(
    t: DataFrame, *, as_of: periods.AsOf = None, days: int | None = 30, approx: bool = False
) -> DataFrame:
    """Monday to Sunday. Grouped by the weekday number; the name is derived from it afterwards."""
    weekdays = aggregate(
        periods.last_days(t, days, as_of),
        [F.weekday(periods.day_of(t)).alias("weekday")],
        [transfers().alias("transfers"), distinct("from_address", approx).alias("unique_users")],
        {"_total": "value"},
    )
    # 2024-01-01 was a Monday, weekday 0.
    name = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("weekday")), "EEEE")
    return (
        _with_mean(weekdays, t, "transfers", "avg_transfer_value")
        .orderBy("weekday")
        .select(name.alias("day_name"), "transfers", "unique_users", "avg_transfer_value")
    )


def chain_overview(t: DataFrame, *, approx: bool = False) -> DataFrame:
    """One row per chain in ``t``."""
    chains = t.groupBy("chain_id").agg(
        transfers().alias("total_transfers"),
        distinct("contract_address", approx).alias("unique_tokens"),
        distinct("from_address", approx).alias("unique_senders"),
        distinct("to_address", approx).alias("unique_receivers"),
        F.min("block_timestamp").alias("earliest_activity"),
        F.max("block_timestamp").alias("latest_activity"),
    )
    named = with_chain(chains)
    return named.select("chain_name", *chains.columns).orderBy("chain_id")


def token_profile(t: DataFrame, token: str, *, approx: bool = False) -> DataFrame:
    """One row, also for a token without transfers."""
    measures = [
        transfers().alias("total_transfers"),
        F.min("block_timestamp").alias("first_transfer"),
        F.max("block_timestamp").alias("latest_transfer"),
    ]
    distincts = {"unique_senders": "from_address", "unique_receivers": "to_address"}
    profile = aggregate_with_distincts(
        t.filter(F.col("contract_address") == token), [], measures, {"total_volume": "value"}, distincts, approx
    )
    profile = _or_zero(profile, "total_volume", "total_transfers")
    average = _mean(amounts_of(t), F.col("total_volume"), F.col("total_transfers"))
    return profile.select(
        "total_transfers",
        "unique_senders",
        "unique_receivers",
        "total_volume",
        average.alias("average_transfer"),
        "first_transfer",
        "latest_transfer",
    )


def user_activity(t: DataFrame, address: str, *, approx: bool = False) -> DataFrame:
    """A Sent and a Received row, from one scan; both rows appear also without transfers."""
    amounts = amounts_of(t)
    measures, shares = [], {}
    for side, column in (("sent", "from_address"), ("received", "to_address")):
        mine = F.col(column) == address
        shares[f"{side}_value"] = amounts.only_if(mine, F.col("value"))
        token = F.when(mine, F.col("contract_address"))
        measures += [F.count_if(mine).alias(f"{side}_count"), distinct(token, approx).alias(f"{side}_tokens")]
    own = t.filter((F.col("from_address") == address) | (F.col("to_address") == address))
    row = aggregate(own.withColumns(shares), [], measures, {f"{name}_total": name for name in shares})

    def entry(label: str, side: str) -> Column:
        total = F.when(F.col(f"{side}_count") == 0, amounts.zero()).otherwise(F.col(f"{side}_value_total"))
        return F.struct(
            F.lit(label).alias("direction"),
            F.col(f"{side}_count").alias("transaction_count"),
            F.col(f"{side}_tokens").alias("unique_tokens"),
            total.alias("total_value"),
        )

    return row.select(F.inline(F.array(entry("Sent", "sent"), entry("Received", "received"))))


def activity_between(
    t: DataFrame, start: str | datetime, end: str | datetime, *, approx: bool = False
) -> DataFrame:
    """Daily activity from ``start`` to ``end``, both inclusive."""
    daily = aggregate(
        periods.between(t, start, end),
        [periods.day_of(t).alias("date")],
        [transfers().alias("daily_transfers"), distinct("contract_address", approx).alias("active_tokens")],
        {"daily_volume": "value"},
    )
    return daily.orderBy(F.desc("date"))
