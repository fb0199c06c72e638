"""Aggregates that are kept up as transfers land: balances, and mergeable sketches by day.

``keep_aggregates`` is a stream over the files of a transfers table. Each batch of new files writes its own partial aggregates
into a folder of its number, and a batch that is replayed overwrites it, so every transfer counts once and a new
day costs its own rows only. Readers merge the partial rows:

``kept_balances``  exact signed changes by chain, token and address; the positive sums are the balances.
``kept_activity``  counts, HyperLogLog sketches of tokens, senders and receivers and KLL sketches of transfer sizes by chain and
                   day, for days or any longer period, without reading a transfer.

``merge_kept`` folds finished batches into one. Transfers may land in any order of time. A replaced block or a dropped
chain takes rows away again, which sketches cannot follow: keep the aggregates anew, in another folder, after that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from transferlens.functions.amounts import U256, aggregate, amounts_of
from transferlens.operators.ledger import ledger_entries
from transferlens.schema import transfers_schema
from transferlens.sources import catalog, files

ACCOUNT = ["chain_id", "contract_address", "address"]
DAY = ["chain_id", "block_date"]
USERS = {"active_tokens": "contract_address", "unique_senders": "from_address", "unique_receivers": "to_address"}
# 2^14 registers, 16 KB: a standard error of 0.8 %. KLL sketches of this k have a rank error of about 0.3 %.
REGISTERS = 14
KLL_K = 1000
BALANCES = T.StructType(
    [
        T.StructField("chain_id", T.LongType()),
        T.StructField("contract_address", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("delta", U256),
    ]
)
DAYS = T.StructType(
    [
        T.StructField("chain_id", T.LongType()),
        T.StructField("block_date", T.DateType()),
        T.StructField("transfers", T.LongType()),
        *(T.StructField(name, T.BinaryType()) for name in USERS),
        T.StructField("sizes", T.BinaryType()),
    ]
)
TABLES = {"balances": BALANCES, "days": DAYS}


def _changes(t: DataFrame) -> DataFrame:
    return aggregate(ledger_entries(t, "chain_id"), ACCOUNT, [], {"delta": "delta"})


def _sketches(t: DataFrame) -> DataFrame:
    users = [F.hll_sketch_agg(column, REGISTERS).alias(name) for name, column in USERS.items()]
    sizes = F.kll_sketch_agg_double(amounts_of(t).to_double(F.col("value")), KLL_K).alias("sizes")
    return t.groupBy(*DAY).agg(F.count(F.lit(1)).alias("transfers"), *users, sizes)


def _fold(rows: DataFrame, name: str) -> DataFrame:
    """Partial rows merged by their keys."""
    if name == "balances":
        return aggregate(rows, ACCOUNT, [], {"delta": "delta"})
    users = [F.hll_union_agg(c).alias(c) for c in USERS]
    return rows.groupBy(*DAY).agg(F.sum("transfers").alias("transfers"), *users, F.kll_merge_agg_double("sizes").alias("sizes"))


def _finished(spark: SparkSession, folder: str) -> tuple[int, list[int]]:
    """The last batch that is folded in (-1 for none), and the batches after it that were written to their end."""
    done = [n for n in files.names(spark, folder) if files.exists(spark, f"{folder}/{n}/_SUCCESS")]
    upto = max((int(n.partition("=")[2]) for n in done if n.startswith("upto=")), default=-1)
    return upto, sorted(b for b in (int(n.partition("=")[2]) for n in done if n.startswith("batch=")) if b > upto)


def _parts(spark: SparkSession, kept: str, name: str, but: int = 0) -> DataFrame:
    """All partial rows: what was folded in, and each later batch (without the last ``but``)."""
    folder = f"{kept}/{name}"
    upto, batches = _finished(spark, folder)
    paths = [f"{folder}/upto={upto}"] * (upto >= 0) + [f"{folder}/batch={b}" for b in batches[: len(batches) - but]]
    return spark.read.schema(TABLES[name]).parquet(*paths) if paths else spark.createDataFrame([], TABLES[name])


def keep_aggregates(spark: SparkSession, table: str, kept: str, *, max_files: int = 1000) -> StreamingQuery:
    """Take up all files that the transfers table got since the last run, then stop.

    ``kept`` is a folder of its own, which also holds the checkpoint; ``max_files`` sizes a batch, all files are read.
    """
    rows = spark.readStream.schema(transfers_schema("u256")).option("maxFilesPerTrigger", max_files).parquet(catalog.location(spark, table))
    rows = rows.select(*DAY, *USERS.values(), "value")

    def process(batch: DataFrame, batch_id: int) -> None:
        # Each reads the files it needs: in a cache, a task would read the whole width of its rows.
        for name, partial in (("balances", _changes(batch)), ("days", _sketches(batch))):
            partial.write.mode("overwrite").parquet(f"{kept}/{name}/batch={batch_id}")

    return (
        rows.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{kept}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def merge_kept(spark: SparkSession, kept: str) -> int:
    """Fold all finished batches but the last into one, between runs of the stream; returns how many.

    The last one may still be replayed. Folders that are folded in go only once the new one is whole, and readers pass them
    over from then on, so a merge that is stopped changes nothing or leaves files that the next one removes.
    """
    folded = 0
    for name in TABLES:
        folder = f"{kept}/{name}"
        upto, batches = _finished(spark, folder)
        older = batches[:-1]
        if older:
            _fold(_parts(spark, kept, name, but=1), name).write.mode("overwrite").parquet(f"{folder}/upto={older[-1]}")
            upto, folded = older[-1], max(folded, len(older))
        for n in files.names(spark, folder):
            kind, _, number = n.partition("=")
            if (kind == "upto" and int(number) < upto) or (kind == "batch" and int(number) <= upto):
                files.delete(spark, f"{folder}/{n}")
    return folded


def kept_balances(spark: SparkSession, kept: str, chain_id: int | None = None) -> DataFrame:
    """Positive balances per chain, token and address of all transfers taken up so far."""
    rows = _parts(spark, kept, "balances")
    rows = rows if chain_id is None else rows.filter(F.col("chain_id") == chain_id)
    return aggregate(rows, ACCOUNT, [], {"balance": "delta"}, positive="balance")


def kept_activity(
    spark: SparkSession, kept: str, *, period: str = "day", quantiles: tuple[float, ...] = (0.5, 0.9, 0.99), chain_id: int | None = None
) -> DataFrame:
    """Per chain and ``period`` ("day", "week", "month", "quarter", "year"): the exact number of transfers, estimates of the distinct
    tokens, senders and receivers, and estimated quantiles of the transfer size, as an array along ``quantiles``."""
    rows = _parts(spark, kept, "days")
    rows = rows if chain_id is None else rows.filter(F.col("chain_id") == chain_id)

    def quantile(q: float) -> Column:
        return F.kll_sketch_get_quantile_double("sizes", F.lit(q))

    merged = _fold(rows.withColumn("block_date", F.trunc("block_date", period) if period != "day" else F.col("block_date")), "days")
    return merged.select(
        "chain_id",
        F.col("block_date").alias("period"),
        "transfers",
        *(F.hll_sketch_estimate(name).alias(name) for name in USERS),
        F.array(*(quantile(q) for q in quantiles)).alias("size_quantiles"),
    )
