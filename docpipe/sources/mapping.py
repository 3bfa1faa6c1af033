"""Mapping files: two columns, split at the first comma only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _valid(value: Column) -> Column:
    return F.make_valid_utf8(value)


def parse_mapping_lines(
    lines: DataFrame, first: str, second: str, line_col: str = "value", carry: Iterable[str] = ()
) -> DataFrame:
    """``first`` is the text before the first comma, ``second`` all the rest or null."""
    halves = F.split(_valid(F.col(line_col)), ",", 2)
    return lines.select(*carry, F.get(halves, F.lit(0)).alias(first), F.get(halves, F.lit(1)).alias(second))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Read mapping files; the first line of each names the two columns.

    Lines end at CR or LF. All files of a folder must have the same header. Exactly one line per
    file is taken as the header: lines equal to it further down are data, wherever the file is split.
    Only header lines and counts come to the driver.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    some = lines.where("start = 0").limit(1).collect()  # the first line of some file: its first bytes only
    if not some:
        raise ValueError(f"mapping file {path} is empty")
    head = some[0]["value"]
    names = head.split(",")
    if len(names) < 2:
        raise ValueError(f"mapping file {path} needs two column names, found {head!r}")
    firsts = first_lines(lines, F.col("value") == head)
    checked = firsts.agg(F.count_if(F.col("first") != F.col("first_alike")), F.sum(F.col("alike") - 1), F.count_if(F.col("alike") == 0))
    different, repeats, without = checked.first()
    if different or without:
        raise ValueError(f"mapping files in {path} have different headers; one of them is {head!r}")
    again = spark.range(repeats).select(F.lit(head).alias("value"))
    return parse_mapping_lines(lines.where(F.col("value") != head).select("value").union(again), names[0], names[1])


def first_lines(lines: DataFrame, alike: Column) -> DataFrame:
    """Per file the place of its first line, that of its first line that is ``alike``, and how many are.

    The first block of a file lies in one task, whose rows are numbered as they are read; least numbers need no order
    in any shuffle.
    """
    first_block = F.col("start") == 0
    return lines.select("path", "start", alike.alias("is_alike"), F.monotonically_increasing_id().alias("at")).groupBy("path").agg(
        F.min(F.when(first_block, F.col("at"))).alias("first"),
        F.coalesce(F.min(F.when(first_block & F.col("is_alike"), F.col("at"))), F.lit(-1)).alias("first_alike"),
        F.count_if("is_alike").alias("alike"),
    )
