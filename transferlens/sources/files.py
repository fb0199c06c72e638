"""Small files and folders beside tables, on the file system that a path names. Uses the driver's JVM, so no Spark Connect."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all it holds; nothing if there is none."""
    system, place = _at(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing if there is none."""
    system, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is there whole or not at all: it is written under another name and then moved."""
    system, place = _at(spark, path)
    _, draft = _at(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(draft, place):
        raise OSError(f"cannot move {draft} to {place}")


def get_text(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
