"""Aggregates that mix amounts with several exact distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.functions.amounts import aggregate
from transferlens.functions.counting import distinct


def aggregate_with_distincts(
    t: DataFrame,
    keys: list[Column | str],
    measures: list[Column],
    totals: dict[str, str],
    distincts: dict[str, str],
    approx: bool = False,
) -> DataFrame:
    """Group by named ``keys`` (none for one row); ``totals`` maps result names to amount columns and
    ``distincts`` to columns whose values are counted.

    One aggregate with several exact distinct counts expands each row once per column, and every expanded
    entry carries the buffers of all other measures through the shuffle. Amount sums are wide, so here the
    measures and the distinct counts are separate aggregates, joined on the keys. They read nearly disjoint
    columns of a columnar table, so the input is not read twice. Both are partitioned by the keys, so the
    join adds no shuffle.
    """
    counts = [distinct(column, approx).alias(name) for name, column in distincts.items()]
    if approx or len(counts) < 2:
        return aggregate(t, keys, [*measures, *counts], totals)
    measured, counted = aggregate(t, keys, measures, totals), t.groupBy(*keys).agg(*counts)
    if keys:
        names = t.select(*keys).columns
        other = counted.withColumnsRenamed({name: f"_{name}" for name in names})
        same = [measured[name].eqNullSafe(other[f"_{name}"]) for name in names]
        return measured.join(other, same).drop(*(f"_{name}" for name in names))
    row = counted.select(F.struct(*distincts)).scalar()
    return measured.select("*", *(row[name].alias(name) for name in distincts))
