"""Token metadata: JSON objects keyed by token address, one or more files per chain.

The chain id comes from the file name, ``tokenMetadata_<chain>.json``. A folder of that name, holding any
number of JSON files, works the same. A file of any size is read by many tasks (see ``json_entries``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.schema import TOKEN_METADATA
from transferlens.sources import catalog
from transferlens.sources.json_entries import read_entries

FILE_NAME = r"tokenMetadata_(\d+)\.json"
LEAST, MOST = -32768, 32767


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per token: its parts, and what kind of JSON it is. An entry that does not parse has a token and no kind."""
    files = read_entries(spark, path, FILE_NAME).withColumnRenamed("key", "files_key")
    files = files.withColumn("chain_id", F.regexp_extract("file", FILE_NAME, 1).cast("bigint"))
    data = files.lateralJoin(spark.tvf.variant_explode_outer(F.col("document").outer()))
    number = F.when(
        F.schema_of_variant(F.try_variant_get("value", "$.decimals", "variant")).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"),
        F.try_variant_get("value", "$.decimals", "double"),
    )
    found = data.select(
        "chain_id",
        "file",
        F.when(F.col("document").isNull(), F.col("files_key")).otherwise(F.col("key")).alias("token"),
        F.col("document").isNull().alias("broken"),
        F.schema_of_variant("value").alias("kind"),
        _text("name").alias("name"),
        _text("symbol").alias("symbol"),
        number.alias("number"),
    )
    return found.withColumn("decimals", F.when(_whole(F.col("number")), F.col("number")).cast("smallint"))


def _text(field: str) -> Column:
    """A string, or the JSON text of anything else but null."""
    part = F.try_variant_get("value", f"$.{field}", "variant")
    nested = F.schema_of_variant(part).rlike("^(OBJECT|ARRAY)")
    return F.when(nested, F.to_json(part)).otherwise(F.try_variant_get("value", f"$.{field}", "string"))


def _whole(number: Column) -> Column:
    return (number == F.floor(number)) & number.between(LEAST, MOST)


def _reason() -> Column:
    return (
        F.when(F.col("token").isNull(), "file is not a JSON object of tokens")
        .when(F.col("broken"), "entry is not valid JSON")
        .when(~F.col("kind").startswith("OBJECT"), "entry is not a JSON object")
        .when(F.coalesce(F.col("name"), F.lit("")) == "", "name is missing or empty")
        .when(F.coalesce(F.col("symbol"), F.lit("")) == "", "symbol is missing or empty")
        .when(F.col("number").isNull(), "decimals is not a number")
        .when(~_whole(F.col("number")), "decimals is not a whole number of 16 bits")
    )


def load_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Valid tokens with lower-case addresses, one row per chain and token.

    Lower-casing can merge two spellings of an address; the smallest (name, symbol, decimals) wins, so
    that joins never multiply rows and reruns agree.
    """
    valid = _entries(spark, path).filter(_reason().isNull())
    return (
        valid.groupBy("chain_id", F.lower("token").alias("contract_address"))
        .agg(F.min(F.struct("name", "symbol", "decimals")).alias("token"))
        .select("chain_id", "contract_address", "token.name", "token.symbol", "token.decimals")
        .withColumn("created_at", F.current_timestamp())
    )


def metadata_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Entries that :func:`load_metadata` leaves out, and files without any entry, with the reason."""
    entries = _entries(spark, path).withColumn("reason", _reason())
    return entries.filter(F.col("reason").isNotNull()).select(
        "chain_id", F.col("token").alias("contract_address"), "name", "symbol", "decimals", "reason"
    )


def write_metadata(m: DataFrame, path: str) -> None:
    """Replace the stored metadata of the chains in ``m`` and keep all others; sorted for lookups by address."""
    if m.isEmpty():
        raise ValueError("no valid token metadata to write")
    fields = [f for f in TOKEN_METADATA.fields if f.name != "chain_id"] + [TOKEN_METADATA["chain_id"]]
    rows = m.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields)).hint("rebalance", F.col("chain_id"))
    blooms = {f"parquet.bloom.filter.enabled#{name}": "true" for name in ("contract_address", "symbol")}
    catalog.save(rows.sortWithinPartitions("chain_id", "contract_address"), path, ["chain_id"], "overwrite", blooms)


def read_metadata(spark: SparkSession, path: str, chain_id: int | None = None) -> DataFrame:
    m = catalog.scan(spark, path, TOKEN_METADATA)
    return m if chain_id is None else m.filter(F.col("chain_id") == chain_id)


def metadata_summary(m: DataFrame) -> DataFrame:
    """Tokens and distinct symbols per chain."""
    return (
        m.groupBy("chain_id")
        .agg(F.count(F.lit(1)).alias("token_count"), F.count_distinct("symbol").alias("unique_symbols"))
        .orderBy("chain_id")
    )
