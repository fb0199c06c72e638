"""The landed transfers table: cleaning, writing, resuming, dropping a chain. Tables go by name or by path (see ``catalog``).

One writer at a time: whoever opens a table finishes a replacement that its writer was stopped in.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.functions.amounts import aggregate, amounts_of
from transferlens.schema import check_chain, transfers_schema
from transferlens.session import shared_folder
from transferlens.sources import catalog, files

# Field widths, and the limits of the size audit.
WIDTHS = {"transaction_hash": 66, "contract_address": 42, "from_address": 42, "to_address": 42}
AUDIT_CHARS = 100
AUDIT_VALUE = 10**30
AUDIT_SAMPLE = 50

IDENTITY = ["chain_id", "block_number", "log_index"]
PARTITIONS = ["chain_id", "block_date"]
SORT = ["contract_address", "block_number", "log_index"]
LOOKUPS = ["contract_address", "from_address", "to_address"]
# Inside the table's folder, passed over by every reader.
PENDING = "_pending"


def sanitize(t: DataFrame) -> DataFrame:
    """Clip hashes and addresses to their width; NULL becomes ''."""
    clipped = {name: F.coalesce(F.substring(name, 1, width), F.lit("")) for name, width in WIDTHS.items()}
    return t.withColumns(clipped)


def oversize_audit(t: DataFrame) -> DataFrame:
    """One row per text field longer than 100 characters and per value above 1e30."""
    amounts = amounts_of(t)

    def finding(name: str, condition: Column, size: Column, sample: Column) -> Column:
        return F.when(
            condition,
            F.struct(F.lit(name).alias("field"), size.cast("int").alias("length"), sample.alias("sample")),
        )

    found = [
        finding(n, F.length(n) > AUDIT_CHARS, F.length(n), F.substring(n, 1, AUDIT_SAMPLE)) for n in WIDTHS
    ]
    text = amounts.to_text(F.col("value"))
    found.append(finding("value", amounts.exceeds(F.col("value"), AUDIT_VALUE), F.length(text), text))
    return t.select("block_number", "log_index", F.inline(F.array_compact(F.array(*found))))


def write_transfers(t: DataFrame, path: str, mode: str = "append") -> None:
    """Land transfers by chain and day, sorted by token and block inside each file.

    ``rebalance`` shuffles by partition; adaptive execution then splits hot days and merges small ones, so
    files have an even size whatever the days look like. The sort gives row groups narrow token ranges, and
    bloom filters let lookups of one token or one address skip row groups. Rows that have a write time keep it.
    """
    finish_pending(t.sparkSession, path)
    _save(t, path, mode)


def _typed(t: DataFrame) -> DataFrame:
    """Rows as the table holds them, with their day and write time."""
    now = F.current_timestamp()
    written = F.coalesce("db_write_timestamp", now) if "db_write_timestamp" in t.columns else now
    landed = t.withColumns({"block_date": F.to_date("block_timestamp"), "db_write_timestamp": written})
    # In the types of the table: one created by name keeps those of its first rows.
    fields = transfers_schema("u256" if isinstance(t.schema["value"].dataType, T.StructType) else "decimal38").fields
    return landed.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))


def _save(t: DataFrame, path: str, mode: str) -> None:
    rows = _typed(t).hint("rebalance", *(F.col(c) for c in PARTITIONS)).sortWithinPartitions(*PARTITIONS, *SORT)
    blooms = {f"parquet.bloom.filter.enabled#{name}": "true" for name in LOOKUPS}
    catalog.save(rows, path, PARTITIONS, mode, {**blooms, "parquet.bloom.filter.adaptive.enabled": "true"})


def read_transfers(
    spark: SparkSession, path: str, chain_id: int | None = None, amounts: str = "u256"
) -> DataFrame:
    """The landed table; ``chain_id`` prunes to the partitions of one chain."""
    finish_pending(spark, path)
    t = catalog.scan(spark, path, transfers_schema(amounts))
    return t if chain_id is None else t.filter(F.col("chain_id") == check_chain(chain_id))


def landed_or_none(spark: SparkSession, path: str, amounts: str = "u256") -> DataFrame | None:
    finish_pending(spark, path)
    return catalog.scan_or_none(spark, path, transfers_schema(amounts))


def resume_point(t: DataFrame) -> DataFrame:
    """The highest stored block, 0 for an empty table."""
    return t.agg(F.coalesce(F.max("block_number"), F.lit(0).cast("bigint")).alias("resume_block"))


def resume_block(spark: SparkSession, path: str, chain_id: int) -> int:
    """The highest stored block of a chain, 0 without any. Read from file footers, whatever the days look like."""
    landed = landed_or_none(spark, path)
    # No file, no footer: an empty table has no schema to read.
    if landed is None or landed.filter(F.col("chain_id") == check_chain(chain_id)).select("chain_id").isEmpty():
        return 0
    return catalog.highest(spark, path, "block_number", {"chain_id": int(chain_id)}).first()["highest"] or 0


def replace_from_block(old: DataFrame, new: DataFrame, block: int | None = None) -> DataFrame:
    """``old`` without its last, maybe incomplete block, plus everything in ``new`` from that block on."""
    last = resume_point(old).scalar() if block is None else F.lit(block).cast("bigint")
    kept = old.filter(F.col("block_number") < last)
    return kept.unionByName(new.filter(F.col("block_number") >= last))


def replace_last_block(
    spark: SparkSession, path: str, new: DataFrame, chain_id: int, amounts: str = "u256"
) -> int:
    """Apply :func:`replace_from_block` to one chain of the landed table; returns the resume block.

    Only days that lose or gain rows are rewritten. They are staged in the shared folder first, because a
    path that is being read must not be overwritten, and then replace their partitions dynamically. ``new``
    is computed once: the days it touches are read back from the staged rows.

    What is to be done is recorded in the table's folder once all rows are staged. A run that is stopped before
    has changed nothing; one that is stopped after it is finished by whoever opens the table next.
    """
    of_chain = F.col("chain_id") == check_chain(chain_id)
    landed = landed_or_none(spark, path, amounts)
    old = None if landed is None else landed.filter(of_chain)
    last = resume_block(spark, path, chain_id)
    staged = shared_folder(spark, "staged-days")
    # Staged as the rows come: they are dealt and sorted once, when they land.
    _typed(new.filter(of_chain & (F.col("block_number") >= last))).write.parquet(staged)
    lost = []
    if old is not None:
        days = catalog.scan(spark, staged, transfers_schema(amounts)).select("block_date")
        of_block = old.filter(F.col("block_number") == last).select("block_date").distinct()
        of_block = spark.createDataFrame(of_block.collect(), of_block.schema)  # the few days of one block
        days = days.union(of_block).distinct()
        kept = old.filter(F.col("block_number") < last).join(days, "block_date", "left_semi")
        _typed(kept).write.mode("append").parquet(staged)
        # Days of the old last block that got no rows are not overwritten, so their partitions go.
        gone = of_block.join(catalog.scan(spark, staged, transfers_schema(amounts)), "block_date", "left_anti")
        lost = [str(row["block_date"]) for row in gone.collect()]
    record = {"chain_id": int(chain_id), "resume_block": last, "staged": staged, "amounts": amounts, "lost": lost}
    if catalog.is_name(path) and landed is None:
        catalog.create(spark, path, transfers_schema(amounts), PARTITIONS, {"partitionOverwriteMode": "dynamic"})
    files.put_text(spark, f"{catalog.location(spark, path)}/{PENDING}/replace-{int(chain_id)}.json", json.dumps(record))
    finish_pending(spark, path)
    return last


def finish_pending(spark: SparkSession, path: str) -> None:
    """Applies the replacements that are recorded in a table's folder. Each step can be repeated."""
    if not catalog.table_exists(spark, path):
        return
    folder = f"{catalog.location(spark, path)}/{PENDING}"
    for name in files.names(spark, folder):
        if not name.endswith(".json"):
            continue
        record = json.loads(files.get_text(spark, f"{folder}/{name}"))
        staged = catalog.scan(spark, record["staged"], transfers_schema(record["amounts"]))
        _save(staged, path, "overwrite")
        catalog.drop_partitions(spark, path, [{"chain_id": record["chain_id"], "block_date": day} for day in record["lost"]])
        files.delete(spark, f"{folder}/{name}")
        files.delete(spark, record["staged"])


def ingest_stats(t: DataFrame, by: str | None = None) -> DataFrame:
    """Events, total value and events per second; ``by="db_write_timestamp"`` gives one row per batch.

    The rate spans the first to the last write, so it is NULL for a single batch.
    """
    counts = [F.count(F.lit(1)).alias("total_events"), F.max("block_number").alias("last_block")]
    totals = {"total_value": "value"}
    if by:
        return aggregate(t, [by], counts, totals).orderBy(by)
    first, last = F.min("db_write_timestamp"), F.max("db_write_timestamp")
    seconds = (F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))).cast("double")
    rate = F.try_divide(F.count(F.lit(1)).cast("double"), seconds / F.lit(1e6).cast("double"))
    return aggregate(t, [], [*counts, rate.alias("events_per_second")], totals)


def without_chain(t: DataFrame, chain_id: int) -> DataFrame:
    return t.filter(F.col("chain_id") != check_chain(chain_id))


def drop_chain(spark: SparkSession, path: str, chain_id: int, amounts: str = "u256") -> int:
    """Remove one chain's partitions from the landed table; returns the number of rows removed, 0 if
    there is no such chain or table. No data is rewritten."""
    landed = landed_or_none(spark, path, amounts)
    rows = 0 if landed is None else landed.filter(F.col("chain_id") == check_chain(chain_id)).count()
    if rows:
        catalog.drop_partitions(spark, path, [{"chain_id": int(chain_id)}])
    return rows
