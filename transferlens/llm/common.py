"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.session import shared_folder

# Fixed values of the contracts: ASCII white space (0x20 and 0x09 to 0x0D) and words between it.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for functions that run in Python there."""
    context = spark.sparkContext
    if getattr(context, "_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in root.rglob("*.py"):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    context._shipped = True


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the folder all executors share, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``function`` for ``mapInArrow``, where a Python worker returns the memory that Arrow keeps for later batches.

    Workers outlive their tasks, so what one stage keeps would count in all stages after it.
    """

    def run(batches):
        try:
            for batch in function(batches):
                yield batch
                del batch
                pa.default_memory_pool().release_unused()
        finally:
            pa.default_memory_pool().release_unused()

    return run


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key's text falls into the fold that training never sees; a null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def about(df: DataFrame, rows: int, by: str | None = None, on: list[str] | None = None) -> DataFrame:
    """All of ``df``, or some ``rows`` of it (of each value of ``by``) that depend on nothing but what they hold, where it has more.

    ``on`` names the columns that decide; those of one side of a join let Spark draw the sample before it joins.
    """
    at = F.xxhash64(*(on or df.columns))
    if by is not None:
        sizes = staged(df.groupBy(by).agg(F.count("*").alias("_rows")), "sample_sizes")
        # The hash as a number from 0 to 1; groups of no more than ``rows`` are taken whole.
        part = at / F.lit(2.0**64) + 0.5
        return df.join(sizes, by).filter((F.col("_rows") <= rows) | (part < rows / F.col("_rows"))).select(*df.columns)
    total = df.count()
    if total <= rows:
        return df
    sample = df.filter(at < F.lit((rows << 64) // total - (1 << 63)))
    if sample.isEmpty():
        raise ValueError(f"a sample of about {rows} of {total} rows is empty: too many of them are equal")
    return sample
