"""Records of landed text files, with their places, from a split scan.

Spark cuts large files into splits and reads each in a task of its own. The
place of a line is the number of lines in the splits before, which ``_metadata`` tells
apart, and its place inside its own split. A cell in quotes may hold line breaks: a line with an
odd number of quotes begins or ends such a cell, so lines between the first
and the second, the third and the fourth and so on belong to one record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abode.session import stage_table

#: Lines of records with line breaks that are looked up by a broadcast; more are dealt out by place.
BROADCAST_LINES = 500_000
#: Encodings whose line breaks are not single bytes: their files are read whole.
WIDE_ENCODINGS = ("UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32")


class RecordError(ValueError):
    """A file ends inside a quoted cell."""


def file_order(spark: SparkSession, path: str) -> list[str]:
    """The files of ``path`` by name; the driver lists them for every scan anyway."""
    return sorted(row[0] for row in spark.read.format("binaryFile").load(path).select("_metadata.file_path").collect())


def _scanned(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(file, block, at, text): lines in the order of ``at`` within a split (``file``, ``block``)."""
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    if encoding.upper() in WIDE_ENCODINGS:
        whole = spark.read.format("binaryFile").load(path).select(meta[0], F.lit(0).cast("long").alias("block"), F.decode("content", encoding).alias("whole"))
        lines = F.split(F.regexp_replace("whole", "(\r\n|\n|\r)\\z", ""), "\r\n|\n|\r")
        return whole.select("file", "block", F.posexplode(lines).alias("at", "text")).withColumn("at", F.col("at").cast("long"))
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.text(path).select(*meta, F.monotonically_increasing_id().alias("at"), text.alias("text"))


def landed_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", quote: str = '"',
                 stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> DataFrame:
    """(nth, line, text, opens, block): every line of every file, written once.

    ``nth`` counts files by name from 1, ``line`` lines of the file from 0, whatever the
    size of splits. ``opens`` is null, or the number of lines with an odd
    number of quotes up to this one. A file that ends inside a quoted cell is an error.
    """
    lines = _scanned(spark, path, encoding)
    odd = (F.length("text") - F.length(F.replace("text", F.lit(quote), F.lit("")))) % 2 == 1
    splits = stage(lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.count_if(odd).alias("odd")), "line-splits")
    open_files = [row["file"] for row in splits.groupBy("file").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").limit(1).collect()]
    if open_files:
        raise RecordError(f"{open_files[0]} ends inside a quoted cell")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    names = spark.createDataFrame([(name, nth) for nth, name in enumerate(file_order(spark, path), 1)], "file string, nth int")
    starts = splits.join(names, "file").select("file", "block", "nth", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before"),
                                               F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("odd_before"))
    # One row a split, of which the driver holds the list: it schedules them.
    placed = lines.join(F.broadcast(starts), ["file", "block"])
    line = F.col("lines_before") + F.col("at") - F.col("first")
    text = F.when(line == 0, F.regexp_replace("text", "^﻿", "")).otherwise(F.col("text"))
    return stage(placed.select("nth", line.alias("line"), text.alias("text"), odd.alias("odd"), "odd_before", "block"), "landed-lines")


def _joined_lines(lines: DataFrame) -> DataFrame:
    """(nth, line, head): the lines that belong to records of more than one, and the first line of each."""
    inside = Window.partitionBy("nth", "block").orderBy("line")
    odd = lines.where("odd").select("nth", "block", "line", "odd_before").withColumn("turn", F.col("odd_before") + F.row_number().over(inside))
    records = odd.groupBy("nth", F.ceil(F.col("turn") / 2).alias("record")).agg(F.min("line").alias("head"), F.max("line").alias("last"))
    return records.select("nth", "head", F.explode(F.sequence("head", "last")).alias("line"))


def landed_records(spark: SparkSession, path: str, encoding: str = "UTF-8", quote: str = '"',
                   stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> DataFrame:
    """(nth, line, text): every record of every file; ``line`` is the place of its first line.

    Lines of one record are joined by a line feed, whatever the file has between them. A
    record is gathered in memory, other lines never move: those of records with line
    breaks are found by a broadcast after a count, beyond ``BROADCAST_LINES`` by place.
    """
    lines = landed_lines(spark, path, encoding, quote, stage)
    if lines.where("odd").limit(1).isEmpty():
        return lines.select("nth", "line", "text")
    joined = stage(_joined_lines(lines), "joined-lines")
    found = F.broadcast(joined) if joined.count() <= BROADCAST_LINES else joined
    marked = lines.select("nth", "line", "text").join(found, ["nth", "line"], "left")
    single = marked.where("head IS NULL").select("nth", "line", "text")
    parts = F.array_sort(F.collect_list(F.struct("line", "text")))
    records = marked.where("head IS NOT NULL").groupBy("nth", "head").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    return single.union(records.select("nth", F.col("head").alias("line"), "text"))
