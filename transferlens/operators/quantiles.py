"""Exact quantiles of any group size, by narrowing histograms.

``percentile`` keeps every distinct value of a group in one task. Here each pass only aggregates:

1. a logarithmic histogram per group (at most 256 bins per factor of two),
2. linear histograms of 4096 pieces inside each cell that holds a wanted rank, again and again until every such cell has
   at most ``most`` values or a single distinct one,
3. value counts inside those cells.

All passes combine map-side, so a group with a third of all rows costs no more than the scan, and no window sees more than
``most`` rows of a cell however the values lie. One pass of step 2 is enough for nearly all data; a cell of doubles
of one logarithmic bin is a single value after four. A quantile interpolates linearly between the two closest ranks.

The cells of a pass are written out, so each pass reads the values once and Spark knows the size of what it may broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferlens.session import staged

BINS_PER_OCTAVE = 256
PIECES = 4096
MOST = 100_000


def _ranks(quantiles: list[float]) -> Column:
    """Zero-based ranks next to each quantile position, from the column ``total``."""
    positions = [(F.col("total") - 1) * F.lit(q) for q in quantiles]
    return F.array(*(edge(p).cast("bigint") for p in positions for edge in (F.floor, F.ceil)))


def _holding_ranks(histogram: DataFrame, group: list[str], order: str, quantiles: list[float]) -> DataFrame:
    """Bins of a histogram that hold a wanted rank; ``before`` becomes the rank of their first value."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = histogram.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return ranked.filter(
        F.exists(_ranks(quantiles), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    )


def log_histogram(values: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, minimum and maximum of the non-negative double ``v`` per key and logarithmic bin."""
    return (
        _binned(values)
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )


def _binned(values: DataFrame) -> DataFrame:
    return values.withColumn("bin", F.floor(F.log2(F.col("v") + 1) * BINS_PER_OCTAVE).cast("int"))


def _inside(values: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """The values that lie in a cell, with what is known of it. Cells of one key do not overlap."""
    edges = cells.select(*keys, "bin", "total", "before", "low", "high")
    return _binned(values).join(edges, [*keys, "bin"]).filter(F.col("v").between(F.col("low"), F.col("high")))


def _narrowed(values: DataFrame, cells: DataFrame, keys: list[str], quantiles: list[float]) -> DataFrame:
    """The pieces of the cells that hold wanted ranks. The least and the greatest value of a cell fall into different ones."""
    share = F.coalesce(F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
    inside = _inside(values, cells, keys).withColumn("piece", F.floor(share * PIECES).cast("int"))
    cell = [*keys, "bin", "cell"]
    pieces = (
        inside.withColumnRenamed("low", "cell")
        .groupBy(*cell, "total", "before", "piece")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    return _holding_ranks(pieces, cell, "piece", quantiles).select(*cells.columns)


def quantiles_from_histogram(
    values: DataFrame,
    histogram: DataFrame,
    keys: list[str],
    quantiles: dict[str, float],
    most: int = MOST,
) -> DataFrame:
    """Exact quantiles of ``v`` for the groups in ``histogram`` (from :func:`log_histogram`).

    The passes up to the last run here; the result is the last one. A group has at most two cells per quantile, so the cells are
    as many as the groups, and Spark broadcasts them if their written size allows it.
    """
    wanted = list(quantiles.values())
    totals = Window.partitionBy(*keys)
    bins = histogram.withColumn("total", F.sum("n").over(totals)).withColumn("before", F.lit(0).cast("bigint"))
    cells = staged(_holding_ranks(bins, keys, "bin", wanted).select(*keys, "bin", "total", "before", "n", "low", "high"), "cells")
    while not cells.filter((F.col("n") > most) & (F.col("low") < F.col("high"))).isEmpty():
        cells = staged(_narrowed(values, cells, keys, wanted), "cells")

    cell = [*keys, "bin", "low"]
    counts = _inside(values, cells, keys).groupBy(*cell, "total", "before", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = _holding_ranks(counts, cell, "v", wanted)

    def at(rank: Column) -> Column:
        held = (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))
        return F.max(F.when(held, F.col("v")))

    position = {name: (F.col("total") - 1) * F.lit(q) for name, q in quantiles.items()}
    found = counts.groupBy(*keys).agg(
        F.max("total").alias("total"),
        *(at(F.floor(p)).alias(f"{name}_low") for name, p in position.items()),
        *(at(F.ceil(p)).alias(f"{name}_high") for name, p in position.items()),
    )
    return found.select(
        *keys,
        "total",
        *(
            (
                F.col(f"{name}_low")
                + (F.col(f"{name}_high") - F.col(f"{name}_low")) * (p - F.floor(p).cast("double"))
            ).alias(name)
            for name, p in position.items()
        ),
    )
