"""The balance ledger: every transfer as a credit and a debit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.functions.amounts import aggregate, amounts_of
from transferlens.schema import ZERO_ADDRESS


def ledger_entries(t: DataFrame, *others: str) -> DataFrame:
    """(``others``, contract_address, address, delta), two rows per transfer from a single scan.

    The zero address, where tokens are minted and burnt, keeps no account.
    """
    amounts = amounts_of(t)
    entries = F.array(
        F.struct(F.col("to_address").alias("address"), F.col("value").alias("delta")),
        F.struct(F.col("from_address").alias("address"), amounts.negate(F.col("value")).alias("delta")),
    )
    return t.select(*others, "contract_address", F.inline(entries)).filter(F.col("address") != ZERO_ADDRESS)


def token_balances(t: DataFrame) -> DataFrame:
    """Positive balance per (contract_address, address).

    The one shuffle is by token and address, after map-side sums, so a hot token spreads over all tasks.
    """
    return aggregate(ledger_entries(t), ["contract_address", "address"], [], {"balance": "delta"}, positive="balance")
