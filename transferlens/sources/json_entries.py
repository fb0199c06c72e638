"""The entries of large JSON objects, read by many tasks.

A JSON object of tokens is one long line as far as Spark's JSON source can tell, so it would be one row of one task. Here
Spark's text source cuts a file at closing braces instead, which it can do from any byte range on, and the pieces are put together again:

1. Whether a piece starts inside a string depends on the number of quotes before it, and its depth on the braces and brackets before it
   that stand outside strings. Both are running sums: within a byte range, then over the ranges of a file. The sum of braces in
   a range is kept for either state it can start in, so one pass over the ranges settles both.
2. An entry begins where a piece starts outside strings at the depth of the object. Pieces are numbered by entry and joined, nearly
   always one piece to an entry.

Files whose quotes or braces do not match cannot be counted through; in these an entry begins wherever text looks like the start of
one (a comma, a quoted hexadecimal address, a colon, a brace), so a broken entry costs itself and not its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transferlens.session import shared_folder

BRACE = "}"
STARTS = r',(?=\s*"0[xX][0-9a-fA-F]*"\s*:\s*\{)'
KEY = r'^\s*"((?:[^"\\]|\\.)*+)"\s*:'
# A string, closed or running on to the end of the piece.
STRING = r'"[^"]*+(?:"|$)'


def _how_many(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("bigint")


def read_pieces(spark: SparkSession, path: str, like: str) -> DataFrame:
    """(file, size, start, nth, piece): what stands between closing braces, with the byte range it was read in and its order there.

    ``like`` is a regular expression that the path of a file has to match.
    """
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", BRACE).text(path)
    pieces = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value").alias("piece"),
    )
    return pieces.filter(F.col("file").rlike(like))


def _counted(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``odd`` (an odd number of quotes before it in its range) and the change of depth if its range starts
    outside (``step0``) or inside (``step1``) a string."""
    plain = F.when(F.contains("piece", F.lit("\\")), F.regexp_replace("piece", r"(?s)\\.", "")).otherwise(F.col("piece"))
    rows = pieces.withColumn("plain", plain).withColumn("quotes", _how_many(F.col("plain"), '"'))
    before = Window.partitionBy("file", "start").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)

    def step(inside: Column) -> Column:
        outside = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), "plain")).otherwise(F.col("plain")), STRING, "")
        closed = (inside.cast("int") + F.col("quotes")) % 2 == 0
        opened = _how_many(outside, "{") + _how_many(outside, "[") - _how_many(outside, "]")
        return opened - closed.cast("bigint")

    return rows.withColumns({"step0": step(F.col("odd")), "step1": step(~F.col("odd"))}).drop("plain")


def _ranges(counted: DataFrame) -> DataFrame:
    """Per byte range: whether it starts inside a string, the depth before it, and whether its whole file matches up."""
    last = F.max_by(F.trim("piece", F.lit(" \t\r\n")) == "", "nth")
    sums = counted.groupBy("file", "start").agg(
        F.sum("quotes").alias("quotes"), F.sum("step0").alias("step0"), F.sum("step1").alias("step1"), last.alias("blank"),
        F.max("size").alias("size"), F.sum(F.octet_length("piece") + 1).alias("bytes"),
    )
    of_file = Window.partitionBy("file")
    before = of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    sums = sums.withColumn("step", F.when(F.col("inside"), F.col("step1")).otherwise(F.col("step0")))
    # Every piece is counted as closed by a brace, also what follows the last brace of a file. Whether anything does is told by the
    # bytes (of which a byte order mark takes three) or, of a compressed file, guessed from a blank end.
    depth, over = F.sum("step").over(of_file), F.sum("bytes").over(of_file) - F.col("size")
    guess = (depth == 0) | (depth == -1) & F.max_by("blank", "start").over(of_file)
    matches = F.when(over.isin(0, -3), depth == 0).when(over.isin(1, -2), depth == -1).otherwise(guess)
    whole = (F.sum("quotes").over(of_file) % 2 == 0) & matches
    return sums.select("file", "start", "inside", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("depth"), whole.alias("whole"))


def read_entries(spark: SparkSession, path: str, like: str) -> DataFrame:
    """(file, key, document): every entry of the JSON objects in the files as an object of its own, a VARIANT.

    An entry that is no valid JSON has a NULL document; ``key`` is its name, NULL where that cannot be told. A file without any entry
    has one row, with an empty or NULL document.
    """
    staged = shared_folder(spark, "json-pieces")
    _counted(read_pieces(spark, path, like)).write.parquet(staged)
    counted = spark.read.parquet(staged)
    # One row per byte range, and so for each maxPartitionBytes of input.
    ranges = F.broadcast(_ranges(counted))
    rows = counted.join(ranges, ["file", "start"])
    in_range = Window.partitionBy("file", "start").orderBy("nth")
    before = in_range.rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(F.col("inside"), F.col("step1")).otherwise(F.col("step0"))
    depth = F.col("depth") + F.coalesce(F.sum(step).over(before), F.lit(0))
    inside = F.col("inside") != F.col("odd")
    first = (F.col("start") == 0) & (F.row_number().over(in_range) == 1)
    begins = first | F.when(F.col("whole"), (depth <= 1) & ~inside).otherwise(F.col("piece").rlike(r"^\s*" + STARTS))
    rows = rows.withColumn("begins", begins)
    # What follows an entry without its closing brace is in the same piece.
    parts = F.when(F.col("whole"), F.array("piece")).otherwise(F.split(F.regexp_replace("piece", r"^\s*" + STARTS, ""), STARTS))
    rows = rows.select("file", "start", "nth", "whole", "begins", F.size(parts).alias("parts"), F.posexplode(parts).alias("part", "piece"))
    rows = rows.select("file", "start", "nth", "whole", "part", "piece", (F.col("begins") | (F.col("part") > 0)).alias("begins"), (F.col("part") == F.col("parts") - 1).alias("closed"))
    in_range = Window.partitionBy("file", "start").orderBy("nth", "part")
    begun = rows.groupBy("file", "start").agg(F.count_if("begins").alias("n"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    of_file = F.sum("n").over(Window.partitionBy("file"))
    begun = F.broadcast(begun.select("file", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"), of_file.alias("entries")))
    here = F.count_if("begins").over(in_range.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.withColumn("here", here).join(begun, ["file", "start"]).withColumn("entry", F.col("earlier") + F.col("here"))
    pieces = F.sort_array(F.collect_list(F.struct("start", "nth", "part", "piece")))
    entries = numbered.groupBy("file", "entry").agg(
        F.array_join(F.transform(pieces, lambda p: p["piece"]), BRACE).alias("text"),
        F.bool_and("closed").alias("closed"),
        (F.bool_and("whole") | (F.max("entry") == F.max("entries"))).alias("open"),
    )
    body = F.when(F.col("entry") == 1, F.regexp_replace("text", r"^\s*\{", "")).otherwise(F.regexp_replace("text", r"^\s*,", ""))
    entries = entries.select("file", "entry", "open", "closed", body.alias("body"))
    entries = entries.filter((F.col("entry") == 1) | (F.trim("body", F.lit(" \t\r\n}")) != ""))
    # The braces that close the entry and the object. The last entry of a file may hold those of the object already.
    closed, closed_once, as_it_is = (F.try_parse_json(F.concat(F.lit("{"), "body", F.lit(BRACE * n))) for n in (2, 1, 0))
    # The parser passes over what follows an object, so one that needs a brace less has one too many where braces do not match up.
    whole = F.when(F.col("open") | (F.trim("body") == ""), F.coalesce(closed, closed_once, as_it_is)).when(closed_once.isNull(), closed)
    document = F.when(F.col("closed"), whole)
    key = F.regexp_extract("body", KEY, 1)
    return entries.select("file", F.when(F.col("body").rlike(KEY), key).alias("key"), document.alias("document"))
