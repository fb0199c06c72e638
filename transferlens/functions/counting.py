"""Distinct counts and averages shared by the analytics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct(column: str | Column, approx: bool = False) -> Column:
    """Exact by default. Several exact distinct counts in one aggregate expand each row once per column;
    ``approx=True`` replaces them by mergeable sketches that need no expansion and no extra shuffle."""
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def transfers() -> Column:
    return F.count(F.lit(1))
