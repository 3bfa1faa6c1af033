"""Extracted text kept as Parquet, partitioned by extension and run date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGES_SCHEMA = "files string, page_no int, page_text string, page_error string"

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("files", T.StringType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("ext", T.StringType()),
    T.StructField("run_date", T.DateType()),
])


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Every row of a snapshot folder, errors and skipped files included."""
    rows = spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)
    # files without an extension are in the partition that Spark names for null
    return rows.withColumn("ext", F.coalesce("ext", F.lit("")))


def read_snapshot(spark: SparkSession, path: str, ext: str, run_date: dt.date) -> DataFrame:
    """``files, raw_text`` of one extension and day; other partitions are not listed."""
    return (
        read_outcomes(spark, path)
        .where((F.col("ext") == ext) & (F.col("run_date") == F.lit(run_date)) & (F.col("status") == "ok"))
        .select("files", "raw_text")
    )


def read_pages_of(spark: SparkSession, path: str, run_date: dt.date) -> DataFrame:
    """Page rows of one day from a page snapshot."""
    rows = spark.read.schema(f"{PAGES_SCHEMA}, run_date date").parquet(path)
    return rows.where(F.col("run_date") == F.lit(run_date)).drop("run_date")


def rows_of_map(df: DataFrame, map_col: str) -> DataFrame:
    """A map of file name to text, one row per entry."""
    return df.select(F.explode(map_col).alias("files", "raw_text"))
