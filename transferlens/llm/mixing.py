"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Every document of a source expects the same number of copies: the source's target over its size. The documents of a
source stand in one order, their expected copies are summed up along it from one random offset per source, and a
document is emitted once for each integer that its own stretch crosses. The order goes by size, so the taken words of
a source stay within about one document of its target.

Positions are counted without bringing a source into one task: documents are counted by source, size class and a hash
bucket of about ``GROUP`` documents, the counts are summed up along these groups, and rows are numbered within a group.

Defined cases: a null text has size 0; a null source is a source of its own, the last; a source of size 0 has target 0
and is not taken; repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm.common import WORDS, staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
GROUP = 256
SEED = "mix"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Sixteen classes for each doubling of the size, so that sizes in a class differ little."""
    bits = F.length(F.bin(size))
    return bits * 16 + F.call_function("shiftright", size, F.greatest(bits - 4, F.lit(0))).cast("int")


def digest(text: Column) -> Column:
    """The first 32 bits of md5; other engines have the same function."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sized: DataFrame, share: float = SHARE, limit: float = LIMIT, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per source: source, source_size, target.

    Sharing the excess of capped sources again until none is above its cap ends at one level of words per weight:
    sources are capped in the order of cap per weight, as long as the level left for the others reaches them.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    first = Window.orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("rank", F.row_number().over(first) - 1)
    by = by.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    along = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(along.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("level", (F.sum("source_size").over(everything) * F.lit(share) - before) / after)
    capped = F.col("cap") <= F.col("level") * F.col("weight")
    by = by.withColumn("capped", capped)
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    by = by.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight")))
    return by.select("source", "source_size", "target")


def copies_of(sized: DataFrame, by_source: DataFrame, seed: str = SEED, group: int = GROUP) -> DataFrame:
    """``sized`` (key, source, size) with source_size, target and the copies that the mix takes."""
    rows = sized.withColumn("class", size_class(F.col("size")))
    classes = rows.groupBy("source", "class").agg(F.count("*").alias("members"))
    up_to_class = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("before_class", F.coalesce(F.sum("members").over(up_to_class), F.lit(0)))
    classes = classes.withColumn("groups", F.ceil(F.col("members") / group))
    key = digest(F.coalesce(F.col("key").cast("string"), F.lit("")))
    rows = same(rows, classes, "source", "class").withColumn("group", F.pmod(key, F.col("groups")))
    counts = rows.groupBy("source", "class", "group", "before_class").agg(F.count("*").alias("members"))
    up_to_group = Window.partitionBy("source", "class").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before_class") + F.coalesce(F.sum("members").over(up_to_group), F.lit(0))
    counts = counts.select("source", "class", "group", before.alias("before"))
    inside = Window.partitionBy("source", "class", "group").orderBy("size", F.col("key").asc_nulls_last())
    rows = rows.select("key", "source", "size", "class", "group", F.row_number().over(inside).alias("number"))
    rows = same(same(rows, counts, "source", "class", "group"), by_source, "source")
    named = F.coalesce(F.concat(F.lit(seed + ":"), F.col("source")), F.lit(seed))
    offset = F.pmod(digest(named), F.lit(65536)) / F.lit(65536.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    up_to = F.col("before") + F.col("number")
    crossed = F.floor(offset + up_to * rate) - F.floor(offset + (up_to - 1) * rate)
    return rows.select("key", "source", "size", "source_size", "target", crossed.alias("copies"))


def same(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Joins on keys of which any can be null; each row has one group."""
    right = groups.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(right[f"_{k}"]) for k in keys))
    return rows.join(right, on).drop(*(f"_{k}" for k in keys))


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", share: float = SHARE,
         limit: float = LIMIT, weights: tuple[float, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken."""
    sized = staged(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words(text).alias("size")), "sizes")
    mixed = copies_of(sized, targets(sized, share, limit, weights), seed)
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", share: float = SHARE,
        limit: float = LIMIT, weights: tuple[float, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns only."""
    names = docs.columns
    chosen = plan(docs, key, text, source, share, limit, weights, seed).select("key", "source", "size", "copies")
    # Repeated rows get numbers on both sides, so that a row meets its own decision and no other.
    alike = Window.partitionBy("key", "source", "size").orderBy("copies")
    chosen = chosen.withColumn("nth", F.row_number().over(alike)).filter("copies > 0")
    held = docs.select(F.struct(*names).alias("row"), F.col(key).alias("key"), F.col(source).alias("source"), words(text).alias("size"))
    held = held.withColumn("nth", F.row_number().over(Window.partitionBy("key", "source", "size").orderBy("size")))
    both = same(held, chosen, "key", "source", "size", "nth")
    return both.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
