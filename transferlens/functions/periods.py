"""Time predicates that also prune day partitions.

``as_of`` stands for the current time and makes results repeatable; ``None`` means now.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME = "block_timestamp"
DAY = "block_date"
AsOf = str | datetime | None


def instant(t: DataFrame, as_of: AsOf = None) -> Column:
    """``as_of`` in the type of the time column, so that comparing needs no cast of the column."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    return now.cast(t.schema[TIME].dataType)


def days_before(t: DataFrame, days: int, as_of: AsOf = None) -> Column:
    return instant(t, as_of) - F.expr(f"INTERVAL '{int(days)}' DAY")


def day_of(t: DataFrame) -> Column:
    """The stored partition day where there is one, else the day of the timestamp."""
    return F.col(DAY) if DAY in t.columns else F.to_date(TIME)


def since(t: DataFrame, start: Column) -> Column:
    condition = F.col(TIME) >= start
    return condition & (F.col(DAY) >= F.to_date(start)) if DAY in t.columns else condition


def until(t: DataFrame, as_of: AsOf = None) -> Column:
    """Whether a transfer is not later than ``as_of``; true where none is given."""
    if as_of is None:
        return F.lit(True)
    end = instant(t, as_of)
    condition = F.col(TIME) <= end
    return condition & (F.col(DAY) <= F.to_date(end)) if DAY in t.columns else condition


def last_days(t: DataFrame, days: int | None, as_of: AsOf = None) -> DataFrame:
    """Transfers from ``as_of`` minus ``days`` up to ``as_of``; without ``days`` all up to it."""
    known = t if as_of is None else t.filter(until(t, as_of))
    return known if days is None else known.filter(since(t, days_before(t, days, as_of)))


def between(t: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Transfers from ``start`` to ``end``, both inclusive."""
    low, high = instant(t, start), instant(t, end)
    condition = F.col(TIME).between(low, high)
    if DAY in t.columns:
        condition &= F.col(DAY).between(F.to_date(low), F.to_date(high))
    return t.filter(condition)


def on_day(t: DataFrame, day: str | date | None = None) -> DataFrame:
    return t.filter(day_of(t) == (F.current_date() if day is None else F.lit(day).cast("date")))
