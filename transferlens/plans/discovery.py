"""Analytics over token metadata."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.operators.ordering import top
from transferlens.schema import with_chain

# The usual numbers of decimals and the default search patterns.
USUAL_DECIMALS = (18, 6, 8)
SYMBOL_PATTERNS = ("%USDC%", "%USD%")
NAME_PATTERNS = ("%USD%",)


def symbol_search(
    m: DataFrame,
    *,
    symbols: Iterable[str] = SYMBOL_PATTERNS,
    names: Iterable[str] = NAME_PATTERNS,
) -> DataFrame:
    """Tokens whose symbol or name matches a pattern, ignoring case, with the number of matches."""
    condition = F.lit(False)
    for column, patterns in (("symbol", symbols), ("name", names)):
        for pattern in patterns:
            condition = condition | F.col(column).ilike(pattern)
    found = m.filter(condition)
    total = found.agg(F.count(F.lit(1)).alias("total"))
    return (
        with_chain(found)
        .select(
            "chain_name",
            "contract_address",
            "name",
            "symbol",
            "decimals",
            total.scalar().alias("total_usdc_variants"),
        )
        .orderBy("symbol", "contract_address")
    )


def metadata_overview(m: DataFrame) -> DataFrame:
    decimals = F.col("decimals")
    return m.agg(
        F.count(F.lit(1)).alias("total_tokens"),
        F.count_distinct("symbol").alias("unique_symbols"),
        F.avg("decimals").alias("avg_decimals"),
        F.count_if(decimals == 18).alias("tokens_18_decimals"),
        F.count_if(decimals == 6).alias("tokens_6_decimals"),
        F.count_if(~decimals.isin(*USUAL_DECIMALS)).alias("unusual_decimals"),
    )


def unusual_decimals(
    m: DataFrame, *, usual: Iterable[int] = USUAL_DECIMALS, limit: int | None = 20
) -> DataFrame:
    unusual = m.filter(~F.col("decimals").isin(*usual)).select("contract_address", "name", "symbol", "decimals")
    return top(unusual, limit, F.desc("decimals"), "contract_address")


def popular_symbols(
    m: DataFrame, *, min_tokens: int = 1, limit: int | None = 20, separator: str = ", "
) -> DataFrame:
    """Symbols that more than ``min_tokens`` tokens share, with the sorted names of those tokens.

    Counting and picking come first; names are only gathered for the symbols in the result, and equal names
    are counted before they are gathered.
    """
    named = m.filter(F.col("symbol") != "")
    order = (F.desc("token_count"), "symbol")
    counts = named.groupBy("symbol").agg(F.count(F.lit(1)).alias("token_count"))
    chosen = top(counts.filter(F.col("token_count") > min_tokens), limit, *order)
    repeated = F.repeat(F.concat("name", F.lit(separator)), F.col("times").cast("int"))
    names = (
        named.join(chosen.select("symbol"), "symbol", "left_semi")
        .groupBy("symbol", "name")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("symbol")
        .agg(F.sort_array(F.collect_list(F.struct("name", repeated.alias("text")))).alias("names"))
        .select("symbol", F.array_join("names.text", "").alias("text"))
        .select("symbol", F.left("text", F.length("text") - len(separator)).alias("token_names"))
    )
    return chosen.join(names, "symbol").orderBy(*order).select("symbol", "token_count", "token_names")
