"""Ordered, limited results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top(df: DataFrame, limit: int | None, *order: Column | str) -> DataFrame:
    """Sort, then keep ``limit`` rows (``None`` keeps all). With a limit Spark plans a top-k per partition."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)
