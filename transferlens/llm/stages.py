"""The operators as stages of the corpus pipeline: (spark, docs, sf_dir) to documents, the last one to token digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.llm import decontamination, mixing, probminhash, wavelet
from transferlens.llm import language as languages
from transferlens.llm.common import held_out, ship, table

# Rows that Spark hands to Python at once. They hold whole texts: its 10,000 would be tens of MB for each task, in the JVM and again in Python.
BATCH = 1_000


def prepare(spark: SparkSession) -> None:
    """Sends the package, and has Spark hand over few rows at once unless the session asks for fewer still."""
    ship(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH:
        spark.conf.set(rows, str(BATCH))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: those without a text or a letter."""
    prepare(spark)
    langs, matrix = languages.learn(docs, ~held_out("doc_id", 4, 2))
    # The text goes to Python once, beside the other columns and not among them.
    others = [c for c in docs.columns if c != "text"]
    held = docs.select(F.struct(*others).alias("row"), "text")
    judged = languages.predict(held, langs, matrix)
    return judged.filter(F.col("lang_pred") != languages.UNKNOWN).select(*("text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    prepare(spark)
    return probminhash.drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources near their target weights."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and reads the documents back from them."""
    import public_tokenizers

    prepare(spark)
    return wavelet.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("key", "doc_id")
