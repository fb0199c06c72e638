"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts (by a short prefix, a 64-bit hash and the key, so that a large
group of copies is dealt over several partitions), each partition is sorted externally by the whole text, and every
text is compared in full with its neighbour. Runs of equal neighbours that a partition border cuts are put together by
their sha256. Splitters are sampled from keys of bounded length, never from whole texts.

Defined cases: a null text counts as empty; a null key sorts last; of rows that repeat the smallest key one stays; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import SPACES, staged

PREFIX = 32
RUNS = "key bigint, text_sha256 string, first bigint, part int, head boolean"


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def runs(batches):
    """Rows of sorted batches with the first key of their run of equal texts, found by comparing neighbours."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    last, first, sha = None, None, None
    for batch in batches:
        texts, keys = batch.column("norm"), batch.column("key")
        if not len(texts):
            continue
        equal = np.zeros(len(texts), bool)
        equal[0] = last is not None and texts[0].as_py() == last
        equal[1:] = pc.equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(~equal)
        shas = [hashlib.sha256(texts[int(i)].as_py().encode()).hexdigest() for i in heads]
        firsts = [keys[int(i)].as_py() for i in heads]
        which = np.cumsum(~equal) - 1
        if equal[0]:
            shas, firsts, which = [sha, *shas], [first, *firsts], which + 1
        take = pa.array(which)
        yield pa.RecordBatch.from_arrays(
            [keys.cast(pa.int64()), pa.array(shas, pa.string()).take(take), pa.array(firsts, pa.int64()).take(take),
             pa.array(np.full(len(texts), part, np.int32)), pa.array(~equal)],
            ["key", "text_sha256", "first", "part", "head"])
        last, first, sha = texts[len(texts) - 1].as_py(), firsts[-1], shas[-1]


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per document: key, keep (the key that stays), group_size, kept, text_sha256."""
    rows = docs.select(F.col(key).cast("long").alias("key"), normalised(text).alias("norm"))
    # The range key, bounded in length; equal texts have equal prefix and hash.
    order = [F.substring("norm", 1, PREFIX).alias("prefix"), F.xxhash64("norm").alias("hash")]
    rows = rows.select("*", *order)
    by = ["prefix", "hash", F.col("key").asc_nulls_last()]
    rows = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    rows = rows.sortWithinPartitions("prefix", "hash", "norm", F.col("key").asc_nulls_last())
    found = staged(rows.select("key", "norm").mapInArrow(runs, RUNS), "runs")
    # A run is one row for each partition that it lies in; its parts meet by their digest.
    parts = found.groupBy("text_sha256", "first", "part").agg(F.count("*").alias("n"))
    start = F.struct(F.col("first").isNull().alias("last"), F.col("first"), F.col("part"))
    groups = parts.groupBy("text_sha256").agg(F.min(start).alias("start"), F.sum("n").alias("group_size"))
    # Written out, so that both sides of the join are shuffled and a hot digest can be split.
    groups = staged(groups, "groups")
    kept = F.col("head") & F.col("first").eqNullSafe(F.col("start.first")) & (F.col("part") == F.col("start.part"))
    return found.join(groups, "text_sha256").select(
        "key", F.col("start.first").alias("keep"), "group_size", kept.alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts: one of those with the smallest key, or with none where all keys are null."""
    names = docs.columns
    stay = exact_groups(docs, key, text).filter("kept").select(F.col("key").alias("_key"), F.col("text_sha256").alias("_sha"))
    held = docs.select(F.struct(*names).alias("row"), F.col(key).cast("long").alias("key"), F.sha2(normalised(text), 256).alias("sha"))
    kept = held.join(stay, held["key"].eqNullSafe(stay["_key"]) & (held["sha"] == stay["_sha"]), "left_semi")
    # Rows that repeat key and text, of which one stays.
    return kept.groupBy("sha").agg(F.first("row").alias("row")).select("row.*")
