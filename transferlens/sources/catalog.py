"""Tables by name or by path.

Everything in this library that takes a table takes either a folder or the name of a table in the session catalog (words joined
by dots: ``transfers``, ``ledger.transfers``; a folder has a slash in it). A table that is written by name and does not exist is created as
a managed, partitioned table. Its partitions go by ``ALTER TABLE … DROP PARTITION``.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.sources import files


def is_name(table: str) -> bool:
    return re.fullmatch(r"(\w+\.){0,2}\w+", table) is not None


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def database_exists(spark: SparkSession, database: str) -> bool:
    return spark.catalog.databaseExists(database)


def list_tables(spark: SparkSession, database: str | None = None, pattern: str | None = None) -> list[str]:
    """Names of the tables of a database (the current one by default), those that match ``pattern`` (with ``*`` and ``|``) if given."""
    return sorted(t.name for t in spark.catalog.listTables(database, pattern) if not t.isTemporary)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) if is_name(table) else files.exists(spark, table)


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    if not is_name(table):
        return table
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def scan(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    if is_name(table):
        return spark.table(table).select(*schema.names)
    return spark.read.schema(schema).parquet(table)


def scan_or_none(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame | None:
    """None where there is no such table yet."""
    if is_name(table):
        return scan(spark, table, schema) if spark.catalog.tableExists(table) else None
    try:
        return scan(spark, table, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def create(spark: SparkSession, table: str, schema: T.StructType, partitions: list[str], options: dict[str, str]) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    told = ", ".join(f"'{k}' = '{v}'" for k, v in options.items())
    keys = ", ".join(f"`{p}`" for p in partitions)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING parquet OPTIONS ({told}) PARTITIONED BY ({keys})")


def save(df: DataFrame, table: str, partitions: list[str], mode: str, options: dict[str, str]) -> None:
    """Appends, or replaces the partitions that ``df`` has rows of (``overwrite``). Partition columns come last."""
    options = {**options, "partitionOverwriteMode": "dynamic"}
    if is_name(table):
        create(df.sparkSession, table, df.schema, partitions, options)
        df.write.options(**options).insertInto(table, overwrite=mode == "overwrite")
    else:
        df.write.mode(mode).partitionBy(*partitions).options(**options).parquet(table)


def drop_partitions(spark: SparkSession, table: str, partitions: list[dict[str, object]]) -> None:
    """Removes partitions, each given by all or the leading partition columns, with their files; absent ones are passed over."""
    if not is_name(table):
        for part in partitions:
            files.delete(spark, "/".join([table.rstrip("/"), *(f"{k}={v}" for k, v in part.items())]))
        return
    held = [dict(p.split("=", 1) for p in r["partition"].split("/")) for r in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()]
    gone = [h for h in held if any(all(h[k] == str(v) for k, v in part.items()) for part in partitions)]
    if gone:
        specs = ", ".join("PARTITION (" + ", ".join(f"`{k}` = '{v}'" for k, v in h.items()) + ")" for h in gone)
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {specs}")


def highest(spark: SparkSession, table: str, column: str, where: dict[str, object]) -> DataFrame:
    """(highest): the largest value of a column in the partitions given by ``where``, NULL without rows.

    It comes from the footers of the files: Spark's newer Parquet reader answers such aggregates from their statistics. It is
    switched on in a session of its own, so that other reads stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = own.read.option("basePath", location(spark, table)).parquet(location(spark, table))
    for name, value in where.items():
        rows = rows.filter(F.col(name) == value)
    return rows.agg(F.max(column).alias("highest"))
